"""Token counts and packing against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wardbook.llm import byte_bpe, packing, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "'s", "'ll", "'RE", " '", "'", "''s", "a", "B", " ", "  ", "\n", "\t", "1", "٣", "é", "漢", "\x85", "\xa0", "　", "<|endoftext|>", "<|",
    "😀", "$$", "\x1c", "ǅ", "Ⅷ", "²", "s", "re", "the", " and", "thing", "\x00", "é",
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(i, "".join(rng.choice(PARTS) for _ in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(400)]
    out += [(i, " ".join("".join(rng.choice(["th", "er", "qu", "zz"]) for _ in range(3)) for _ in range(rng.randrange(200, 3000)))) for i in range(400, 430)]
    return out + [(500, None), (501, ""), (502, "x" * 20000), (503, "ab " * 4000), (3, "again"), (3, "again"), (None, "no id"), (505, "<|endoftext|>")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS key", "1 AS length").repartition(3)


@pytest.fixture(scope="module")
def ids(rows):
    t = Tokenizer.from_file(PATH)
    return [x.ids for x in t.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]


def test_counts(docs, rows, ids):
    got = sorted((tuple(r) for r in token_counts.counted(docs, PATH).collect()), key=str)
    want = [(i, len((t or "").encode()), len(x), len(x) > 1024) for (i, t), x in zip(rows, ids)]
    assert got == sorted(want, key=str)


def test_every_character_is_split_as_the_library_does(rows):
    import sys

    from tokenizers.pre_tokenizers import ByteLevel

    vocabulary, library = byte_bpe.Vocabulary(PATH), ByteLevel(add_prefix_space=False)
    import pyarrow as pa

    from wardbook.llm import spans

    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    text = "".join(f" a{c}1{c}{c}" for c in random.Random(0).sample(chars, 60000))
    t = next(spans.texts([pa.RecordBatch.from_pydict({"text": [text]})], max_bytes=1 << 30))
    start, end, _ = byte_bpe.pre_tokens(t, vocabulary)
    letters = byte_bpe.byte_letters()
    want = [x for x, _ in library.pre_tokenize_str(text)]
    assert ["".join(letters[b] for b in text.encode()[s:e]) for s, e in zip(start, end)] == want


def test_packed(docs, rows, ids):
    got = packing.packed(docs, PATH).collect()
    assert got[0].asDict().keys() == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    want = Counter()
    for (i, _), x in zip(rows, ids):
        x, start, piece = [*x, 2], 0, 0
        while start < len(x):
            n = (len(x) - start) % 1024 or 1024
            want[i, piece, start, n, zlib.crc32(np.array(x[start : start + n], "<u4").tobytes())] += 1
            start, piece = start + n, piece + 1
    assert Counter(tuple(r)[:5] for r in got) == want
    at = defaultdict(list)
    for r in got:
        at[r.sequence_id].append((r.offset, r.length))
    for parts in at.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= 1024
    lengths = sorted((r.length for r in got), reverse=True)
    assert len(at) <= max(-(-sum(lengths) // 1024), sum(n > 512 for n in lengths)) * 1.02 + 1


def test_sequences(docs, rows, ids):
    got = packing.sequences(docs.filter("doc_id < 420"), PATH, packing.Capacity(tokens=256, documents=4, cost=256 * 256)).collect()
    assert all(len(r.ids) <= 256 and len(r.doc_ids) <= 4 for r in got)
    assert sum(len(r.ids) for r in got) == sum(len(x) + 1 for (i, _), x in zip(rows, ids) if i is not None and i < 420)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    length = np.random.default_rng(1).integers(1, 60, 700)
    number, offset = packing.best_fit(length, packing.Capacity(100, 4, 4000, (1, 1, 1), rule))
    for b in np.unique(number):
        own = np.flatnonzero(number == b)
        assert length[own].sum() <= 100 and len(own) <= 4 and (length[own] ** 2).sum() <= 4000
        order = own[np.argsort(offset[own], kind="stable")]
        assert (offset[order] == np.append(0, np.cumsum(length[order])[:-1])).all()
    # No sequence could have taken a smaller one whole.
    assert len(np.unique(number)) <= 1.3 * max(length.sum() / 100, len(length) / 4, (length**2).sum() / 4000)
    with pytest.raises(ValueError):
        packing.best_fit(np.array([101]), packing.Capacity(100))


def test_without_rows(docs):
    assert token_counts.counted(docs.limit(0), PATH).count() == 0
    assert packing.packed(docs.limit(0), PATH).count() == 0
