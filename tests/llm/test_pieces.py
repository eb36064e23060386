"""Encoding against a plain search of all segmentations, decoding against the sentencepiece library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from wardbook.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def plain(library):
    """Best paths by trying every piece at every place of the whole text."""
    n = library.vocab_size()
    usual = [i for i in range(n) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
    ids = {library.id_to_piece(i): i for i in usual}
    longest, unknown = max(map(len, ids)), min(library.get_score(i) for i in usual) - 10

    def encode(text):
        if not text:
            return []
        text = (" " + text).replace(" ", MARK)
        best = [(0.0, [])] + [None] * len(text)
        for at in range(len(text)):
            for end in range(at + 1, min(len(text), at + longest) + 1):
                i = ids.get(text[at:end])
                if i is None and end > at + 1:
                    continue
                own = [i] if i is not None else [library.piece_to_id(f"<0x{b:02X}>") for b in text[at].encode()]
                score = best[at][0] + (library.get_score(i) if i is not None else unknown)
                if best[end] is None or score > best[end][0]:
                    best[end] = score, best[at][1] + own
        return best[-1][1]

    return encode


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    parts = ["the", "Er", "ing", " ", "  ", "é", "漢", "😀", "\n", "\t", "x", "9", "##", MARK, "ß", "\x00", "<0x0A>", "<s>", " and ", "tion"]
    out = [(i, "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 4, 30])))) for i in range(300)]
    return out + [(400, None), (401, " "), (402, "a" * 3000), (403, "word " * 2000), (3, "twice"), (3, "twice"), (None, "no id")]


MARK = "▁"


def test_encoded_and_decoded(spark, library, plain, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "'x' AS decoded")
    got = pieces.decoded(pieces.encoded(docs, PATH), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.text or ""
        if len(text) < 1000:
            assert r.ids == plain(text), repr(text)
        assert r.decoded == library.decode(r.ids) and (MARK in text or r.decoded == text)
    digests = pieces.digest(pieces.decoded(pieces.encoded(docs, PATH), PATH)).collect()
    want = sorted((str(r.doc_id), len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()), r.decoded == (r.text or "")) for r in got)
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in digests) == want


def test_every_key_is_found():
    rng = random.Random(1)
    keys = {bytes(rng.choices(b"abc\xff\x00", k=rng.randrange(1, 9))): i for i in range(2000)}
    trie = pieces.DoubleArray(keys)

    def find(key):
        state = 0
        for c in key:
            child = trie.base[state] + c
            if child >= len(trie.check) or not child or trie.check[child] != state:
                return -1
            state = child
        return trie.value[state]

    assert all(find(k) == i for k, i in keys.items())
    assert all(find(k) == -1 for k in (bytes(rng.choices(b"abcd", k=9)) for _ in range(500)) if k not in keys)


def test_any_byte_may_follow_a_state():
    """The walk needs no check of the arrays' ends."""
    for keys in ({b"\xff" * 5: 0}, {bytes([c, 255]): c for c in range(256)}, {b"a": 0}):
        trie = pieces.DoubleArray(keys)
        assert len(trie.check) == len(trie.base) == len(trie.value) > max(trie.base) + 255


def test_broken_bytes_and_no_rows(spark):
    docs = spark.createDataFrame([(1, [3 + 0xC3, 3 + 0x28]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in pieces.decoded(docs, PATH).orderBy("doc_id").collect()] == ["�(", "", ""]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.digest(pieces.decoded(pieces.encoded(empty, PATH), PATH)).count() == 0
