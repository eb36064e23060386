"""Both substring operators against a plain search for repeated windows."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardbook.llm import recompression, repeats, spans, suffix_dedup

SIZE = 50


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def covered(rows, size=SIZE):
    """Per row: the set of covered word places."""
    starts = defaultdict(lambda: float("inf"))
    for i, text in rows:
        w = split(text)
        for s in range(len(w) - size + 1):
            k = tuple(w[s : s + size])
            starts[k] = min(starts[k], i)
    out = []
    for i, text in rows:
        w, places = split(text), {}
        for s in range(len(w) - size + 1):
            first = starts[tuple(w[s : s + size])]
            if first < i:
                for p in range(s, s + size):
                    places[p] = min(first, places.get(p, first))
        out.append(places)
    return out


def test_recompression(corpus, corpus_frame):
    got = sorted(tuple(r) for r in recompression.digest(corpus_frame).collect())
    want = []
    for (i, text), places in zip(corpus, covered(corpus)):
        w = split(text)
        kept = " ".join(x for p, x in enumerate(w) if p not in places)
        want.append((i, len(w), len(places), hashlib.sha256(kept.encode()).hexdigest()))
    assert got == sorted(want)
    assert sum(r[2] for r in got) > 3000


def test_suffix_passages(corpus, corpus_frame):
    got = sorted(tuple(r) for r in suffix_dedup.repeated_passages(corpus_frame).collect())
    want = []
    for (i, text), places in zip(corpus, covered(corpus)):
        w, at = split(text), None
        for p in [*sorted(places), None]:
            if at is not None and p != at + n:
                want.append((i, at, n, " ".join(w[at : at + n])))
                at = None
            if p is not None:
                at, n = (p, 1) if at is None else (at, n + 1)
    assert sorted((i, at, n, " ".join(split(p))) for i, at, n, _, p in got) == sorted(want)
    assert len(got) > 50
    windows = defaultdict(set)
    for i, text in corpus:
        w = split(text)
        windows[i] |= {tuple(w[s : s + SIZE]) for s in range(len(w) - SIZE + 1)}
    for i, _, n, first, passage in got:
        w = split(passage)
        assert first < i and any(tuple(w[s : s + SIZE]) in windows[first] for s in range(n - SIZE + 1))


def passages_of(frame):
    return sorted((r.doc_id, r.first_word, r.n_words, r.first_doc_id, r.passage) for r in suffix_dedup.repeated_passages(frame).collect())


@pytest.mark.parametrize("held", [1, 7, 60])
def test_suffixes_compared_few_at_a_time(spark, corpus, corpus_frame, monkeypatch, held):
    """Intervals that borders cut are settled by the names of their windows: the same places."""
    monkeypatch.setattr(suffix_dedup, "HELD", held)
    want = {(i, p) for (i, _), places in zip(corpus, covered(corpus)) for p in places}
    assert {(i, p) for i, at, n, *_ in passages_of(corpus_frame) for p in range(at, at + n)} == want


@pytest.mark.parametrize("held", [3, 1 << 14])
def test_suffixes_are_extended_to_both_sides(spark, monkeypatch, held):
    """A passage of the window's length, one word more or less, between different words in many documents, and two
    that part before or after a common core."""
    monkeypatch.setattr(suffix_dedup, "HELD", held)
    core, rows = [f"c{i}" for i in range(60)], []
    for k in range(40):
        rows.append((k, " ".join([f"{k}_{i}" for i in range(30)] + core[: 48 + k % 5] + [f"{k}-{i}" for i in range(30)])))
        rows.append((100 + k, " ".join([f"l{k % 3}_{i}" for i in range(20)] + core[10:45] + [f"r{k % 4}_{i}" for i in range(20)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted((i, len(places)) for (i, _), places in zip(rows, covered(rows)) if places)
    kept = suffix_dedup.without_repeats(docs.withColumn("old", F.col("text"))).collect()
    assert sorted((r.doc_id, n) for r in kept if (n := len(split(r.old)) - len(split(r.text)))) == want


@pytest.mark.parametrize("held", [3, 50, 1 << 14])
def test_a_common_passage_has_few_rows(spark, monkeypatch, held):
    """Neighbouring windows of a passage in very many documents are found as runs, wherever borders cut its suffixes."""
    monkeypatch.setattr(suffix_dedup, "HELD", held)
    core = [f"c{i}" for i in range(90)]
    rows = [(k, " ".join([f"{k}_{i}" for i in range(60)] + core + [f"{k}-{i}" for i in range(60)])) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marks = repeats.mark(docs, suffix_dedup.name_windows, SIZE)
    runs = repeats.original_runs(marks, repeats.placed(marks)).groupBy("doc_id").agg(F.collect_set(F.struct("seq", "first", "n")).alias("runs"))
    found = suffix_dedup.extended_matches(docs.join(runs, "doc_id"), SIZE).collect()
    places = {(r.doc_id, p) for r in found for p in range(r.first, r.first + r.n)}
    assert places == {(k, p) for k in range(1, 300) for p in range(60, 101)} and {r.first_id for r in found} == {0}
    # A row for each suffix, of which a passage has few, not for each of the 41 windows.
    assert len(found) <= 299 * 10


@pytest.mark.parametrize("operator", [recompression, suffix_dedup])
def test_very_long_texts(spark, operator):
    rng = random.Random(2)
    a = [f"w{rng.randrange(30000)}" for _ in range(40000)]
    b = a[:9000] + ["x"] + a[9000:21000] + [f"w{rng.randrange(30000)}" for _ in range(9000)] + a[30000:]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, "y" * 300000 + " " + " ".join(b[100:20000]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [len(places) for places in covered(rows)]
    if operator is recompression:
        got = [r.n_removed for r in sorted(recompression.digest(docs).collect())]
    else:
        kept = sorted(suffix_dedup.without_repeats(docs).collect())
        got = [len(split(text)) - len(split(r.text)) for (_, text), r in zip(rows, kept)]
    assert got == want and want[1] > 30000 and want[2] > 19000


def test_suffix_cut(spark, corpus, corpus_frame):
    docs = corpus_frame.withColumns({"spans": F.lit(1), "row": F.lit("x"), "n_chars": F.length("text").cast("long")})
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = sorted((r.doc_id, r.text is None, split(r.text), r.spans, r.row, r.n_chars) for r in out.collect())
    want, text_of = [], {}
    for (i, text), places in zip(corpus, covered(corpus)):
        want.append((i, text is None, [x for p, x in enumerate(split(text)) if p not in places], 1, "x"))
        if not places:
            text_of[i] = text
    assert [r[:5] for r in got] == sorted(want)
    assert {r.doc_id: r.text for r in out.collect() if r.doc_id in text_of} == text_of


@pytest.mark.parametrize("operator", [recompression.digest, suffix_dedup.repeated_passages, suffix_dedup.without_repeats])
def test_empty_and_null_ids(spark, operator):
    schema = "doc_id long, text string"
    assert operator(spark.createDataFrame([], schema)).count() == 0
    text = " ".join(f"x{i}" for i in range(60))
    docs = spark.createDataFrame([(None, text), (None, text), (3, text), (4, text + " y")], schema)
    got = operator(docs).collect()
    if operator is recompression.digest:
        assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (0, 0), (3, 0), (4, 60)]
    elif operator is suffix_dedup.repeated_passages:
        assert [(r.doc_id, r.first_word, r.n_words, r.first_doc_id) for r in got] == [(4, 0, 60, 3)]
    else:
        assert sorted((r.doc_id or 0, len(r.text)) for r in got) == [(0, len(text)), (0, len(text)), (3, len(text)), (4, 1)]


def test_one_id_two_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    docs = spark.createDataFrame([(1, a), (2, a + " tail"), (2, b)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in recompression.digest(docs).collect())
    assert got == [(1, 60, 0), (2, 60, 0), (2, 61, 60)]


@pytest.mark.parametrize("operator", [recompression, suffix_dedup])
def test_block_twice_around_an_earlier_passage(spark, operator):
    """Every occurrence counts, of a block that its smallest document holds again and of one in two texts of one id."""
    rows = []
    for k in range(12):
        q, p, end = ([f"{c}{k}_{i}" for i in range(60)] for c in "qpe")
        block = q + p if k % 2 else p + q
        rows += [(10 * k, " ".join(p)), (10 * k + 1, " ".join(block * 3 + q)), (10 * k + 2, " ".join(end + block * 2))]
        rows += [(10 * k + 3, " ".join([f"x{k}", *block, *end, *block])), (10 * k + 3, " ".join([f"y{k}", *block]))]
        a, b = ([f"{c}{k}_{i}" for i in range(60)] for c in "ab")
        rows += [(200 + 10 * k, " ".join(a)), (201 + 10 * k, " ".join(["s", *b, *a, *b])), (201 + 10 * k, " ".join(["t", *b, *a, *b]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((i, len(split(text)), len(places)) for (i, text), places in zip(rows, covered(rows)))
    if operator is recompression:
        got = sorted((r.doc_id, r.n_words, r.n_removed) for r in recompression.digest(docs).collect())
    else:
        kept = suffix_dedup.without_repeats(docs.withColumn("old", docs.text)).collect()
        got = sorted((r.doc_id, len(split(r.old)), len(split(r.old)) - len(split(r.text))) for r in kept)
    assert got == want


def test_names_of_windows_at_borders_by_parts(monkeypatch):
    """A task's words are hashed some suffixes at a time, to the same names as all at once."""
    rng, size, seed = np.random.default_rng(5), 50, 16
    right, left = (rng.integers(0, 1 << 63, (300, n)).astype(np.uint64) for n in (size, size - seed))
    own, before = rng.integers(0, 300, 700), rng.integers(0, size - seed + 1, 700)
    n = np.minimum(rng.integers(1, 30, 700), before + 1)
    words = np.concatenate([left[:, ::-1], right], axis=1)
    start = spans.ranges(own * words.shape[1] + left.shape[1] - before, n)
    want = [p.hash(start, start + size, 3).view(np.int64) for p in (spans.word_prefix(words.ravel()), spans.other_prefix(words.ravel()))]
    hashed, whole = [], spans.word_prefix
    monkeypatch.setattr(spans, "word_prefix", lambda w: hashed.append(len(w)) or whole(w))
    for most in (7, 1 << 10):
        monkeypatch.setattr(suffix_dedup, "NAMED", most)
        got = suffix_dedup._names(right, left, own, before, n, size)
        assert all((a == b).all() for a, b in zip(got, want))
        assert max(hashed) <= min(most, 300) * words.shape[1] and sum(hashed) == len(np.unique(own)) * words.shape[1]
        hashed.clear()


def test_range_min():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1000, 300).astype(np.uint64)
    lo = rng.integers(0, 300, 500)
    hi = np.minimum(lo + rng.integers(0, 70, 500), 299)
    assert list(repeats.range_min(v, lo, hi)) == [min(v[a : b + 1]) for a, b in zip(lo, hi)]


def test_window_names_have_independent_halves(monkeypatch):
    """Words that the first hash confuses are told apart by the second."""
    import pyarrow as pa

    words = spans.words

    def confused(*args):
        w = words(*args)
        w.hash[:] = 1
        return w

    monkeypatch.setattr(spans, "words", confused)
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "aab"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": texts})
    w = confused(next(spans.texts([batch])))
    seq = spans.word_prefix(w.hash).hash(w.first[:-1], w.first[1:], 1).view(np.int64)
    batch = batch.append_column("runs", pa.array([[{"seq": s, "first": 0, "n": 11}] for s in seq.tolist()]))
    out = pa.Table.from_batches(repeats._windows(SIZE)([batch]))
    w1, w2 = (out[c].to_numpy().reshape(3, 11) for c in ("w1", "w2"))
    assert len(set(w1.ravel())) == 1
    assert (w2[0] == w2[1]).all() and len(set(w2.ravel())) == 22


def test_spans_hash_by_content():
    import pyarrow as pa

    text = "the cat sat on the mat the cat ran"
    t = next(spans.texts([pa.RecordBatch.from_pydict({"text": [text, None, text]})]))
    w = spans.words(t)
    assert list(w.counts) == [9, 0, 9] and list(w.hash[:9]) == list(w.hash[9:])
    assert len(set(w.hash)) == len(set(text.split()))
