"""Texts as byte arrays: cutting Arrow batches, finding words, hashing spans, all with numpy.

An Arrow text column is already one run of UTF-8 bytes with offsets, so a batch of documents is worked
on as a whole, without a Python object per document or word. Memory is bounded by ``MAX_BYTES`` of text
per step (or by one document, if that is longer) and by ``MAX_ROWS`` documents.
"""

import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_BYTES, MAX_ROWS = 1 << 18, 1 << 9
U64 = np.uint64
# The multipliers of the mixer, and the bases of the two polynomials over words.
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
_SEED_STEP = 0x9E3779B97F4A7C15
_WORD_BASE, _OTHER_WORD_BASE = 0x11342543DE82EF95, 0x07037ED1A0B428DB
# Bytes from which a span is hashed on its own.
_LONG_SPAN = 512
# The polynomials are taken modulo this Mersenne prime. (Modulo 2**64 they collide on Thue-Morse sequences
# whatever the base.)
PRIME = (1 << 61) - 1
_P, _LOW31, _LOW30 = U64(PRIME), U64((1 << 31) - 1), U64((1 << 30) - 1)

# ASCII white space: the six bytes that end a word.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ U64((seed * _SEED_STEP) & (2**64 - 1))
    for m in _MIX:
        x = (x ^ (x >> U64(33))) * U64(m)
    return x ^ (x >> U64(33))


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> U64(61))
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it, by halves of 30 and 31 bits."""
    a1, a0, b1, b0 = a >> U64(31), a & _LOW31, b >> U64(31), b & _LOW31
    middle = a1 * b0 + a0 * b1
    return _reduced(((a1 * b1) << U64(1)) + (middle >> U64(30)) + ((middle & _LOW30) << U64(31)) + a0 * b0)


def _sums(values: np.ndarray) -> np.ndarray:
    """Running sums modulo the prime, from 0."""
    high, low = (np.zeros(len(values) + 1, np.uint64) for _ in range(2))
    np.cumsum(values >> U64(31), out=high[1:])
    np.cumsum(values & _LOW31, out=low[1:])
    return _reduced(_reduced(low) + (high >> U64(30)) + ((high & _LOW30) << U64(31)))


class _Powers:
    """Powers of a base modulo the prime and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.next = [base, pow(base, -1, PRIME)]
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.tables[0]) < n:
            for k in (0, 1):
                self.tables[k] = np.append(self.tables[k], _times(self.tables[k], U64(self.next[k])))
                self.next[k] = self.next[k] ** 2 % PRIME
        return self.tables[0][:n], self.tables[1][:n]


_WORD_POWERS, _OTHER_WORD_POWERS = _Powers(_WORD_BASE), _Powers(_OTHER_WORD_BASE)


class Prefix:
    """Hashes of any span of a sequence of 64-bit values, from one running sum."""

    def __init__(self, values: np.ndarray, powers: _Powers):
        up, self.down = powers.upto(len(values) + 1)
        self.sums = _sums(_times(_reduced(values), up[: len(values)]))

    def hash(self, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        raw = _times(_reduced(self.sums[end] + (_P - self.sums[start])), self.down[start])
        return mix(raw + mix((np.asarray(end) - start).astype(np.uint64)), seed)


def word_prefix(hashes: np.ndarray) -> Prefix:
    return Prefix(hashes, _WORD_POWERS)


def other_prefix(hashes: np.ndarray) -> Prefix:
    """Over the same values as ``word_prefix``, by another base."""
    return Prefix(mix(hashes, 1002), _OTHER_WORD_POWERS)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes mixed in at a time. Two seeds give independent hashes."""
    length = (end - start).astype(np.int64)
    out = mix(length.astype(np.uint64), seed)
    if not len(data):
        return out
    blocks = np.ndarray((len(data),), np.uint64, np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    rows = np.flatnonzero((length > 0) & (length <= _LONG_SPAN))
    at, left = start[rows], length[rows]
    while len(rows):
        block = blocks[at] & np.where(left >= 8, U64(2**64 - 1), (U64(1) << (U64(8) * np.minimum(left, 7).astype(np.uint64))) - U64(1))
        out[rows] = mix(out[rows] ^ block, seed + 1)
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length > _LONG_SPAN):
        digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little"))
        out[i] = int.from_bytes(digest.digest(), "little")
    return out


def same_bytes(a: np.ndarray, a_start: np.ndarray, b: np.ndarray, b_start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether spans of one length hold the same bytes, pair by pair."""
    equal = a[ranges(a_start, length)] == b[ranges(b_start, length)]
    return segment_sums(equal, np.append(0, np.cumsum(length))) == length


@dataclass
class Texts:
    """Some documents: their rows of the batch, their bytes end to end, and where each starts."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def column(self, name: str) -> np.ndarray:
        return self.rows.column(self.rows.schema.get_field_index(name)).to_numpy(zero_copy_only=False)

    def text_bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def _string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1 + column.offset)[column.offset :] if n else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """What Arrow and the C library keep for later, which a worker would hold through all tasks it is used for."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def giving_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; at their end, unused memory goes back to the system."""
    yield from batches
    give_back()


def texts(batches: Iterator[pa.RecordBatch], max_bytes: int = MAX_BYTES) -> Iterator[Texts]:
    """The batches' documents in steps of at most ``max_bytes`` of text and ``MAX_ROWS`` rows; a null text is empty.
    Texts are in the column ``text``, or in the field of that name of the struct ``row``."""
    for batch in giving_back(batches):
        at = batch.schema.get_field_index("text")
        offsets, data = _string_parts(batch.column(at) if at >= 0 else pc.struct_field(batch.column(batch.schema.get_field_index("row")), "text"))
        first = 0
        while first < len(batch):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1)
            last = min(last, first + MAX_ROWS, len(batch))
            own = offsets[first : last + 1]
            yield Texts(batch.slice(first, last - first), data[own[0] : own[-1]], own - own[0])
            first = last


@dataclass
class Words:
    """The words of some documents: byte spans, hashes, and each document's first word (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Each word's document."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def doc_end(self) -> np.ndarray:
        """Each word's document end, as a word number."""
        return np.repeat(self.first[1:], self.counts)


def edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True bytes, cut at document borders too."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    return starts, np.flatnonzero(inside & (~after | border[1:])) + 1


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(docs: Texts, data: np.ndarray | None = None) -> Words:
    """Runs of bytes other than ASCII white space. ``data`` may be a rewritten copy, as in lower case."""
    data = docs.data if data is None else data
    start, end = edges(~_SPACE[data], docs.offsets)
    return Words(start, end, span_hash(data, start, end), np.searchsorted(start, docs.offsets))


def windows(w: Words, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``size`` words within a document."""
    n = len(w)
    start = np.flatnonzero(np.arange(n) + size <= w.doc_end()) if n else np.zeros(0, np.int64)
    return start, word_prefix(w.hash).hash(start, start + size, seed)


def other_word_prefix(docs: Texts, w: Words) -> Prefix:
    """For hashes independent of ``word_prefix``'s: another hash of the words' bytes and another base. (The
    same hash under two seeds is one hash: equal under one seed, it is equal under both.)"""
    return Prefix(span_hash(docs.data, w.start, w.end, 1001), _OTHER_WORD_POWERS)


def joined_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> list[str]:
    """The texts of documents whose words, given by byte spans and cut at ``first``, are joined by single spaces."""
    # Each word with one byte after it, which becomes the space between.
    n = end - start + 1
    out = np.append(data, np.uint8(32))[ranges(start, n)]
    ends = np.cumsum(n)
    out[ends - 1] = 32
    until = np.append(0, ends)[first]
    raw = out.tobytes()
    return [raw[a : max(a, b - 1)].decode() for a, b in zip(until[:-1].tolist(), until[1:].tolist())]


def word_numbers(docs: Texts, w: Words) -> np.ndarray:
    """A number for each word, the same for equal words only: those of one hash are compared by bytes."""
    _, one, number = np.unique(w.hash, return_index=True, return_inverse=True)
    own, size = one[number], w.end - w.start
    alike = size[own] == size
    alike[alike] = same_bytes(docs.data, w.start[own[alike]], docs.data, w.start[alike], size[alike])
    odd = np.flatnonzero(~alike)
    if len(odd):
        others = {}
        for i in odd.tolist():
            number[i] = others.setdefault(docs.data[w.start[i] : w.end[i]].tobytes(), len(one) + len(others))
    return number


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive positions of ``first``."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all the ranges ``start .. start + length - 1``, one after the other."""
    total = int(length.sum())
    at = np.repeat(np.cumsum(length) - length, length)
    return np.arange(total) - at + np.repeat(start, length)


def histogram(t: Texts, bins: np.ndarray, count: int, first: np.ndarray | None = None) -> np.ndarray:
    """Per document (a row each), how many of its bytes (or of the elements that ``first`` cuts) fall into
    each of ``count`` bins."""
    first = t.offsets if first is None else first
    at = np.repeat(np.arange(len(t)) * count, np.diff(first)) + bins[first[0] : first[-1]]
    return np.bincount(at, minlength=len(t) * count).reshape(len(t), count)


def with_column(rows: pa.RecordBatch, drop: tuple[str, ...] = ("text",), **new) -> pa.RecordBatch:
    """The batch without some columns and with new ones at its end."""
    names = [n for n in rows.schema.names if n not in drop]
    cols = [rows.column(rows.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*cols, *[v if isinstance(v, pa.Array) else pa.array(v) for v in new.values()]], names=[*names, *new])
