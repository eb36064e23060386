"""Hashes on sequences that polynomials modulo 2**64 confuse, and where hits are compared by bytes."""

import hashlib
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wardbook.llm import ngram_join, packing, pieces, quality_rules, recompression, spans, suffix_dedup, token_counts
from wardbook.llm.byte_bpe import Memory


def thue_morse(n, a, b):
    return [(a, b)[i.bit_count() & 1] for i in range(n)]


A, B = "".join(thue_morse(1024, "a", "b")), "".join(thue_morse(1024, "b", "a"))
WORDS = [" ".join(thue_morse(1024, *x)) for x in ("xy", "yx")]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def of(texts):
    return next(spans.texts([pa.RecordBatch.from_pydict({"text": texts})]))


def test_arithmetic_modulo_the_prime():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, spans.PRIME, (2, 3000), dtype=np.uint64)
    a[:3], b[:3] = [0, 1, spans.PRIME - 1], [spans.PRIME - 1] * 3
    assert spans._times(a, b).tolist() == [x * y % spans.PRIME for x, y in zip(a.tolist(), b.tolist())]
    sums = [0]
    for x in a.tolist():
        sums.append((sums[-1] + x) % spans.PRIME)
    assert spans._sums(a).tolist() == sums


def test_spans_of_all_lengths():
    data = np.frombuffer((A + B + "c" * 700 + "d" * 700 + "c" * 700).encode(), np.uint8)
    start, end = (x.ravel() for x in np.meshgrid(np.arange(0, len(data) - 800, 37), np.arange(0, 800, 13)))
    end = end + start
    by_hash = {}
    for a, b, h in zip(start.tolist(), end.tolist(), spans.span_hash(data, start, end).tolist()):
        by_hash.setdefault(h, set()).add(data[a:b].tobytes())
    assert all(len(x) == 1 for x in by_hash.values())
    assert len(by_hash) == len({x for v in by_hash.values() for x in v})


def test_no_collision_on_thue_morse():
    w = spans.words(of([A, B]))
    assert w.hash[0] != w.hash[1]
    t = of(WORDS)
    w = spans.words(t)
    for p in (spans.word_prefix(w.hash), spans.other_word_prefix(t, w)):
        a, b = p.hash(w.first[:-1], w.first[1:])
        assert a != b


def test_memory_compares_bytes():
    data = np.frombuffer(b"onetwothreeone", np.uint8)
    start, end = np.array([0, 3, 6, 11]), np.array([3, 6, 11, 14])
    memory = Memory(lambda raw: list(raw))
    for _ in range(2):
        at, length = memory.look_up(np.full(4, 9, np.uint64), data, start, end)
        assert [memory.values[a : a + n].tobytes() for a, n in zip(at, length)] == [np.array(list(x), np.int32).tobytes() for x in (b"one", b"two", b"three", b"one")]


def test_memory_holds_a_large_vocabulary():
    """Pre-tokens seen before are seldom taken apart again, however many others came between."""
    calls = []
    memory = Memory(lambda raw: calls.append(raw) or [len(raw)])
    n, step = 200_000, 10_000
    data = np.arange(n, dtype=np.uint64).view(np.uint8)
    for k in range(2 * n // step):
        start = 8 * np.arange(k * step % n, k * step % n + step)
        _, length = memory.look_up(spans.span_hash(data, start, start + 8), data, start, start + 8)
        assert (length == 1).all()
        if k == n // step - 1:
            assert len(calls) == n
    assert len(calls) - n < 0.25 * n


def test_memory_is_reserved_once():
    """Filling the table copies nothing, and it is never larger than its limit and one step."""
    memory = Memory(lambda raw: [len(raw)], places=1 << 16, store=1 << 17)
    values, keys = memory.values, memory.keys
    data = np.arange(30_000, dtype=np.uint64).view(np.uint8)
    for k in range(3):
        start = 8 * np.arange(k * 10_000, (k + 1) * 10_000)
        memory.look_up(spans.span_hash(data, start, start + 8), data, start, start + 8)
    assert memory.used == 30_000 and memory.values is values and memory.keys is keys
    # One text longer than all that is reserved.
    long = np.zeros(1 << 21, np.uint8)
    for _ in range(3):
        at, length = memory.look_up(np.array([7], np.uint64), long, np.array([0]), np.array([len(long)]))
        assert memory.values[at[0]] == len(long) and length[0] == 1
    other = np.ones(8, np.uint8)
    memory.look_up(np.array([8], np.uint64), other, np.array([0]), np.array([8]))
    assert len(memory.keys) == len(keys) and memory.used == 1


def test_workers_give_memory_back(monkeypatch):
    """At the end of a task's batches, once, and not before."""
    calls = []
    monkeypatch.setattr(spans, "give_back", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_pydict({"text": ["a b", None, "c"]})] * 2
    found = spans.texts(iter(batches))
    assert sum(len(next(found)) for _ in batches) == 6 and not calls
    assert list(found) == [] and calls == [1]


def test_unused_memory_goes_back():
    pool = pa.default_memory_pool()
    kept = pa.array([0])
    spans.give_back()
    assert pool.bytes_allocated() >= kept.nbytes and kept.to_pylist() == [0]


def test_tokens_of_thue_morse(spark, library):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, A), (2, B), (3, f"{A} {B}")], SCHEMA).coalesce(1)
    assert {r.doc_id: r.n_tokens for r in token_counts.counted(docs, path).collect()} == {r.doc_id: len(library(r.text)) for r in docs.collect()}
    for r in packing.packed(docs, path).filter("piece = 0 and length < 1024").collect():
        ids = library({1: A, 2: B, 3: f"{A} {B}"}[r.doc_id]) + [2]
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)[: 4 * r.length])
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert pieces.decoded(pieces.encoded(docs, path), path).filter("decoded = text").count() == 3


def test_one_other_word_is_no_repeat(spark):
    rows = [(i, " ".join([*(f"l{k}" for k in range(49)), x, *(f"r{k}" for k in range(49))])) for i, x in ((1, A), (2, B))]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert [r.n_removed for r in recompression.digest(docs).collect()] == [0, 0]
    assert suffix_dedup.repeated_passages(docs).count() == 0


def test_other_sequences_are_no_copies(spark):
    docs = spark.createDataFrame([(1, WORDS[0]), (2, WORDS[1]), (3, A), (4, B), (5, A)], SCHEMA)
    got = {r.doc_id: r.component_id for r in ngram_join.joined(docs, n=4, percent=85).collect()}
    # The two long sequences have the same few shingles.
    sets = [{tuple(x.split()[i : i + 4]) for i in range(1021)} for x in WORDS]
    assert got == {1: 1, 2: 1 if sets[0] == sets[1] else 2, 3: 3, 4: 4, 5: 3}
    removed = {r.doc_id: r.kept_sha256 for r in recompression.digest(docs).collect()}
    assert removed[3] == removed[5] == hashlib.sha256(A.encode()).hexdigest() != removed[4]


def test_lines_and_repeats(spark):
    docs = spark.createDataFrame([(1, f"{A}\n{B}\n{A}")], SCHEMA)
    assert quality_rules.judged(docs).first().n_dup_lines == 1
