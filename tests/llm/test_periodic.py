"""Runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from wardbook.llm import periodic, queries


def plain_runs(words, least=12):
    """For each period the maximal stretches; of one stretch the smallest period."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(least, 2 * q):
                found.setdefault((s, length), q)
    return sorted((s, q, n) for (s, n), q in found.items())


def runs(words, least=12):
    number = np.unique(np.array(words), return_inverse=True)[1] if words else np.zeros(0, np.int64)
    return sorted(zip(*(x.tolist() for x in (lambda s, n, q: (s, q, n))(*periodic.runs_of(number, np.array([0, len(words)]), least)))))


@pytest.mark.parametrize("seed", range(12))
def test_random_sequences(seed):
    rng = random.Random(seed)
    for _ in range(150):
        letters = rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(letters) for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(4)):
            at, p = rng.randrange(len(words) + 1), [rng.randrange(letters + 1) for _ in range(rng.randrange(1, 9))]
            words[at:at] = (p * rng.randrange(1, 8))[: rng.randrange(1, 40)]
        for least in (12, 4, 2):
            assert runs(words, least) == plain_runs(words, least)


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize(
    "words",
    [
        [0] * 3000, [0, 1] * 800, fibonacci(1500), [i.bit_count() & 1 for i in range(1024)],
        [x for k in range(200) for x in [1000 + k, *[0] * 7]], [x for k in range(30) for x in [1000 + k, *[0] * (k + 3)]],
        [x for k in range(60) for x in [*range(20), 500 + k]], list(range(40)) * 9 + list(range(17)), [0] * 11, [0] * 12, [],
    ],
)
def test_repetitive_sequences(words):
    assert runs(words) == plain_runs(words)


def test_several_sequences_at_once():
    rng = random.Random(5)
    docs = [[rng.randrange(3) for _ in range(rng.choice([0, 1, 30, 60]))] for _ in range(40)] + [[7] * 20, [7] * 20, []]
    first = np.append(0, np.cumsum([len(d) for d in docs]))
    start, length, period = periodic.runs_of(np.array([x for d in docs for x in d]), first)
    want = [(s + f, q, n) for d, f in zip(docs, first) for s, q, n in plain_runs(d)]
    assert sorted(zip(start.tolist(), period.tolist(), length.tolist())) == want


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected(doc_id, text, plant):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if plant and doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    drop = {i for s, q, k in found for i in range(s + q, s + k)}
    s, q, k = min(found, key=lambda r: (-r[2], r[0], r[1]), default=(None,) * 3)
    lines = "".join(f"{s},{k},{q}\n" for s, q, k in found)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return doc_id, len(found), s, k, q, k and 1000 * k // q, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in drop))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [(None, "a " * 30), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "x"), (4, "x"), (-7, "b c " * 9 + "\x0bd")]
    out += [(5, "Ünï cödé 漢字 " * 30), (6, "w " * 40_000), (7, " ".join(map(str, range(3000))) + "\n" + "line one two\r\n" * 20)]
    for i in range(10, 400):
        words = [str(rng.randrange(rng.choice([3, 50, 5000]))) for _ in range(rng.choice([0, 1, 5, 40, 150]))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = [str(rng.randrange(9)) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 9)
        out.append((i, rng.choice([" ", "  ", "\n"]).join(words)))
    return out


def test_query(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.repartition(4).selectExpr("*", "1 AS runs", "'y' AS collapsed").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = [tuple(r) for r in got.collect()]
    assert sorted(map(str, (r for r in found if r[0] != 6))) == sorted(str(expected(*r, True)) for r in rows if r[0] != 6)
    one = got.filter("doc_id = 6").first()
    assert (one.n_runs, one.start, one.length, one.period, one.exponent_milli) == (1, 0, 40_000, 1, 40_000_000)


def test_operator(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = periodic.with_runs(docs)
    got = sorted(map(str, (tuple(r) for r in periodic.digest(found).filter("doc_id is null or doc_id != 6").collect())))
    assert got == sorted(str(expected(*r, False)) for r in rows if r[0] != 6)
    by_id = {r.doc_id: r for r in found.filter("doc_id in (5, 6, 7)").collect()}
    assert by_id[5].collapsed == "Ünï cödé 漢字" and by_id[6].collapsed == "w" and by_id[6].n_words == 40_000
    assert [tuple(r) for r in by_id[7].runs] == [(3000, 60, 3)]


def test_empty_table(spark):
    assert periodic.digest(periodic.with_runs(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
