"""Repeated passages by recompression.

Rounds name runs of one symbol and then pairs of symbols, from single words up. A pair is merged when a
hash of the round and the symbol puts the left one in one half of the alphabet and the right one in the
other, so no two pairs compete for a symbol. A new symbol's name is a hash of its parts: every task gives
the same name without a table of names, so the rounds need no shuffle, and equal texts have equal symbols
except near their ends.

Each symbol carries the interval of words that decided it: its own, those of the neighbours that kept it
from merging, and all their parts'. A window whose words include that interval would have the symbol in any
document. Among these the one with the smallest hash stands for the window, together with the words that
decided it. A window in which none is safe (of long runs, say) goes down to the highest level that has one.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm import repeats as R
from wardbook.llm import spans as S

ROUNDS = 4
_OUTSIDE = np.iinfo(np.int64).max // 2


def _group(values: np.ndarray, at: np.ndarray, how) -> np.ndarray:
    return how.reduceat(values, at) if len(values) else values


class Symbols:
    """A level: names, documents, and the words each symbol depends on (``lo`` to ``hi``, ends included)."""

    def __init__(self, w: S.Words):
        self.name, self.doc = w.hash, w.doc()
        self.lo = np.arange(len(w))
        self.hi = np.arange(len(w))

    def _neighbours(self):
        """Whether a symbol has one before and after it in its document; where it has none, what decides
        its fate lies outside every window."""
        same = self.doc[1:] == self.doc[:-1]
        before_lo = np.where(np.append(False, same), np.append(0, self.lo[:-1]), -_OUTSIDE)
        after_hi = np.where(np.append(same, False), np.append(self.hi[1:], 0), _OUTSIDE)
        return same, before_lo, after_hi

    def _cut(self, at: np.ndarray, name: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        self.lo, self.hi = _group(lo, at, np.minimum), _group(hi, at, np.maximum)
        self.doc, self.name = self.doc[at], name

    def name_runs(self) -> None:
        """A run depends on the symbols beside it, which end it."""
        if not len(self.name):
            return
        same, before_lo, after_hi = self._neighbours()
        at = np.flatnonzero(np.append(True, ~same | (self.name[1:] != self.name[:-1])))
        n = np.diff(np.append(at, len(self.name)))
        name = np.where(n > 1, S.mix(self.name[at] + n.astype(np.uint64), 11), self.name[at])
        self._cut(at, name, np.minimum(self.lo, before_lo), np.maximum(self.hi, after_hi))

    def name_pairs(self, number: int) -> None:
        if not len(self.name):
            return
        same, before_lo, after_hi = self._neighbours()
        right = (S.mix(self.name, 100 + number) & np.uint64(1)).astype(bool)
        joins = same & ~right[:-1] & right[1:]  # symbol i with i + 1
        merged = np.append(joins, False) | np.append(False, joins)
        # What kept a single symbol from merging: a left one looks at the next, a right one at the one before.
        lo = np.where(~merged & right, np.minimum(self.lo, before_lo), self.lo)
        hi = np.where(~merged & ~right, np.maximum(self.hi, after_hi), self.hi)
        at = np.flatnonzero(~np.append(False, joins))
        pair = S.mix(self.name * np.uint64(0x9E3779B97F4A7C15) + np.append(self.name[1:], np.uint64(0)), 12)
        self._cut(at, np.where(np.append(joins, False), pair, self.name)[at], lo, hi)


def name_windows(w: S.Words, start: np.ndarray, size: int, rounds: int = ROUNDS) -> np.ndarray:
    symbols, levels = Symbols(w), []
    for r in range(rounds + 1):
        inside = (symbols.lo > -_OUTSIDE) & (symbols.hi < _OUTSIDE)
        # Both ends rise along a document: a round takes them from the same or a neighbouring symbol.
        levels.append((symbols.lo[inside], symbols.hi[inside], symbols.name[inside]))
        symbols.name_runs()
        symbols.name_pairs(r)
    words = S.word_prefix(w.hash)
    key, rest = np.zeros(len(start), np.uint64), np.arange(len(start))
    # Single words are always safe, so every window finds its level.
    for r in range(rounds, -1, -1):
        lo, hi, name = levels[r]
        left, last = np.searchsorted(lo, start[rest]), np.searchsorted(hi, start[rest] + size) - 1
        safe = last >= left
        if safe.any():
            name = S.mix(name ^ words.hash(lo, hi + 1, 13), 13 + r)
            key[rest[safe]] = R.range_min(name, left[safe], last[safe])
            rest = rest[~safe]
    return key


def shared_runs(runs: DataFrame) -> DataFrame:
    """Runs whose symbol occurs in two or more documents."""
    keys = runs.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("key")
    return runs.join(keys, "key")


def repeated_spans(docs: DataFrame, size: int = R.WINDOW) -> DataFrame:
    """Per document that repeats a passage of a document with a smaller id: its spans."""
    marks = R.mark(docs, name_windows, size)
    placed = R.placed(marks)
    return R.covered(docs, placed, shared_runs(R.original_runs(marks, placed)), size)


def kept_words(docs: DataFrame, size: int = R.WINDOW) -> DataFrame:
    """Per row of ``docs`` (``doc_id`` and ``text`` are used): ``doc_id``, ``n_words``, ``n_removed`` and
    ``kept_text``, the words that no repeated window covers, joined by single spaces.

    Words end at ASCII white space. A null text has no words; a text of fewer than ``size`` words is kept;
    a row without an id is kept and removes nothing; rows of one id never remove from each other; an empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            w = S.words(t)
            cover, _ = R.cover_mask(w, t, size)
            keep = np.flatnonzero(~cover)
            kept = S.segment_sums(~cover, w.first)
            text = S.joined_words(t.data, w.start[keep], w.end[keep], np.append(0, np.cumsum(kept)))
            yield pa.RecordBatch.from_arrays(
                [t.rows.column(0), pa.array(w.counts.astype(np.int64)), pa.array(w.counts - kept, pa.int64()), pa.array(text, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    spans = repeated_spans(docs, size)
    rows = R.with_spans(docs.select("text", "doc_id"), spans).select("doc_id", "row.text", "spans")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")


def digest(docs: DataFrame, size: int = R.WINDOW) -> DataFrame:
    """``kept_words`` with the text's SHA-256 in its place."""
    return kept_words(docs, size).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
