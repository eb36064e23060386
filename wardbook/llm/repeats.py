"""Long passages that repeat across documents: what the two substring operators share.

A *window* is ``size`` consecutive words of one document. A word is covered if a window over it also
starts in a document with a smaller id. Both operators find the same words, in their own ways of naming
places that equal windows must have in common:

1. ``mark`` reads every text once. A function given by the operator names each window by something inside
   it, such that equal windows get equal names and neighbouring windows mostly share one. Runs of windows
   with one name are stored per document, beside a hash of its word sequence.
2. Exact copies are settled by that hash alone: all but the smallest id are covered whole.
3. The operator says which names occur in two or more of the other documents. Only these runs go on.
4. A run whose whole segment (the words of all its windows) is also in a smaller document is settled by the
   segment's hash. Of each segment all the smallest document's runs go on if its name has other segments.
5. ``covered`` reads the texts of these runs again, and a function given by the operator finds the windows of
   theirs that a smaller document has too. ``equal_windows`` names every window by two independent 64-bit hashes of
   its words, which verifies a match. The smallest id of each is taken with map-side partial results, so a passage in
   a third of all documents is no single task's work.

Rows without an id take no part. Rows that share an id are told apart by their words.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm import spans as S
from wardbook.llm.scratch import stored

WINDOW = 50
WHOLE = -1
_RUN = pa.struct([("key", pa.int64()), ("segment", pa.int64()), ("first", pa.int32()), ("n", pa.int32())])
_MARKS = "doc_id long, seq long, seq2 long, n_words long, runs array<struct<key: long, segment: long, first: int, n: int>>"


def sequence_hash(w: S.Words, p: S.Prefix | None = None) -> np.ndarray:
    """Of each document's whole word sequence."""
    return (p or S.word_prefix(w.hash)).hash(w.first[:-1], w.first[1:], 1).view(np.int64)


def window_starts(w: S.Words, size: int) -> np.ndarray:
    return np.flatnonzero(np.arange(len(w)) + size <= w.doc_end())


def range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of ``values[lo..hi]``, both ends included, for many ranges at once."""
    out = np.zeros(len(lo), values.dtype)
    level = np.frexp((hi - lo + 1).astype(float))[1] - 1
    table, width = values, 1
    for k in range(int(level.max(initial=-1)) + 1):
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(table[lo[own]], table[hi[own] - width + 1])
        if len(table) <= width:
            break
        table, width = np.minimum(table[:-width], table[width:]), 2 * width
    return out


def _runs(w: S.Words, start: np.ndarray, key: np.ndarray, size: int) -> pa.ListArray:
    """Neighbouring windows of one document with one name, as a list per document."""
    doc = w.doc()[start] if len(start) else start
    new = np.ones(len(start), bool)
    new[1:] = (key[1:] != key[:-1]) | (start[1:] != start[:-1] + 1) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    first, n = start[at], np.diff(np.append(at, len(start)))
    segment = S.word_prefix(w.hash).hash(first, first + n + size - 1, 5)
    rows = [key[at].view(np.int64), segment.view(np.int64), (first - w.first[doc[at]]).astype(np.int32), n.astype(np.int32)]
    offsets = np.searchsorted(doc[at], np.arange(len(w.first))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(r) for r in rows], fields=list(_RUN)))


Namer = Callable[[S.Words, np.ndarray, int], np.ndarray]


def mark(docs: DataFrame, namer: Namer, size: int) -> DataFrame:
    """Per document: its word sequence's hashes, word count and runs of equally named windows; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            w = S.words(t)
            start = window_starts(w, size)
            seq, seq2 = sequence_hash(w), sequence_hash(w, S.other_word_prefix(t, w))
            cols = [t.rows.column(0), seq, seq2, w.counts.astype(np.int64), _runs(w, start, namer(w, start, size), size)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=["doc_id", "seq", "seq2", "n_words", "runs"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    return stored(own.mapInArrow(run, _MARKS), "marks")


def placed(marks: DataFrame) -> DataFrame:
    """Per document: ``first_id``, the smallest id with the same word sequence; stored."""
    sequences = marks.groupBy("seq", "seq2").agg(F.min("doc_id").alias("first_id"))
    return stored(marks.select("doc_id", "seq", "seq2", "n_words").join(sequences, ["seq", "seq2"]), "placed")


def original_runs(marks: DataFrame, placed: DataFrame) -> DataFrame:
    """The runs (key, segment, doc_id, seq, first, n) of the documents that are no exact copies."""
    originals = placed.filter("first_id = doc_id").select("doc_id", "seq", "seq2")
    return marks.filter(F.size("runs") > 0).join(originals, ["doc_id", "seq", "seq2"], "left_semi").select("doc_id", "seq", F.inline("runs"))


def run_windows(t: S.Texts, w: S.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of the runs given with each text: their documents, these documents' sequence hashes, and where
    they start."""
    seq = sequence_hash(w)
    lists = t.rows.column(t.rows.schema.get_field_index("runs"))
    doc = np.repeat(np.arange(len(t)), lists.value_lengths().to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    own, first, n = (flat.field(k).to_numpy() for k in ("seq", "first", "n"))
    ok = seq[doc] == own
    doc, first, n = doc[ok], first[ok].astype(np.int64), n[ok].astype(np.int64)
    start = S.ranges(first + w.first[doc], n)
    doc = np.repeat(doc, n)
    return doc, seq[doc], start


def _windows(size: int):
    """Every window of the runs given with each text, by a 128-bit name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            w = S.words(t)
            doc, seq, start = run_windows(t, w)
            p, other = S.word_prefix(w.hash), S.other_word_prefix(t, w)
            ids = t.column("doc_id")[doc] if len(doc) else doc
            cols = [p.hash(start, start + size, 3).view(np.int64), other.hash(start, start + size, 3).view(np.int64), ids.astype(np.int64), seq, (start - w.first[doc]).astype(np.int32)]
            for at in range(0, len(start), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)]) for c in cols], names=["w1", "w2", "doc_id", "seq", "start"])

    return run


def first_ids(windows: DataFrame) -> DataFrame:
    """Of named windows (w1, w2, doc_id, seq, start), those that a smaller document has too, with its id."""
    firsts = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    firsts = firsts.filter("first_id < last_id").drop("last_id")
    hits = windows.join(firsts, ["w1", "w2"]).filter("first_id < doc_id")
    return hits.select("doc_id", "seq", "first_id", F.col("start").alias("first"), F.lit(1).alias("n"))


def equal_windows(texts: DataFrame, size: int) -> DataFrame:
    """Of the windows of the ``runs`` given with ``texts``: (doc_id, seq, first_id, first, n), those that a smaller
    document's runs have too."""
    return first_ids(stored(texts.mapInArrow(_windows(size), "w1 long, w2 long, doc_id long, seq long, start int"), "windows"))


Finder = Callable[[DataFrame, int], DataFrame]


def covered(docs: DataFrame, placed: DataFrame, shared: DataFrame, size: int, find: Finder = equal_windows) -> DataFrame:
    """Per document with covered words: ``spans``, a list of (seq, first_id, ranges of covered windows).

    ``shared`` has the runs (key, segment, doc_id, seq, first, n) whose names occur in several documents. A
    whole copy has the single range that starts at ``WHOLE``.
    """
    copies = placed.filter((F.col("first_id") < F.col("doc_id")) & (F.col("n_words") >= size))
    whole = copies.select("doc_id", "seq", "first_id", F.lit(WHOLE).alias("first"), F.lit(1).alias("n"))

    shared = stored(shared, "shared_runs")
    # The first and the last run of the smallest document, which differ if it holds the segment again.
    least = F.min(F.struct("doc_id", "seq", "first", "n")).alias("least")
    last = F.min(F.struct("doc_id", F.bitwise_not("seq").alias("seq"), F.bitwise_not("first").alias("first"))).alias("last")
    segments = shared.groupBy("key", "segment").agg(least, last, F.max("doc_id").alias("last_id"))
    twice = (F.bitwise_not("last.seq") != F.col("least.seq")) | (F.bitwise_not("last.first") != F.col("least.first"))
    segments = stored(segments.withColumn("twice", twice).drop("last"), "segments")
    again = segments.filter(F.col("least.doc_id") < F.col("last_id")).select("key", "segment", F.col("least.doc_id").alias("first_id"))
    settled = shared.join(again, ["key", "segment"]).filter("first_id < doc_id").select("doc_id", "seq", "first_id", "first", "n")

    several = segments.groupBy("key").agg(F.min("segment").alias("a"), F.max("segment").alias("b")).filter("a < b")
    opened = segments.join(several.select("key"), "key")
    twice = stored(opened.filter("twice").select("key", "segment", F.col("least.doc_id").alias("first_id")), "twice")
    again = shared.join(twice, ["key", "segment"]).filter("first_id = doc_id").select("doc_id", "seq", "first", "n")
    open_runs = opened.filter("not twice").select("least.*").unionByName(again)
    runs = open_runs.groupBy("doc_id").agg(F.collect_set(F.struct("seq", "first", "n")).alias("runs"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(runs, "doc_id")
    return (
        find(texts, size)
        .unionByName(settled)
        .unionByName(whole)
        .repartition("doc_id")
        .groupBy("doc_id", "seq", "first_id")
        .agg(F.collect_set(F.struct("first", "n")).alias("ranges"))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("seq", "first_id", "ranges")).alias("spans"))
    )


def cover_mask(w: S.Words, t: S.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For the words of ``t``, whose rows carry ``spans``: covered or not, and the smallest id known to have
    a window over the word."""
    out, owner = np.zeros(len(w), bool), np.full(len(w), np.iinfo(np.int64).max)
    lists = t.rows.column(t.rows.schema.get_field_index("spans"))
    if lists.null_count == len(lists):
        return out, owner
    seq = sequence_hash(w)
    doc = np.repeat(np.arange(len(t)), np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(int))
    flat = lists.flatten()
    own, first_id, ranges = flat.field("seq").to_numpy(), flat.field("first_id").to_numpy(), flat.field("ranges")
    inner = ranges.flatten()
    first, n = (inner.field(k).to_numpy() for k in ("first", "n"))
    at = np.append(0, np.cumsum(ranges.value_lengths().to_numpy()))
    for i in np.argsort(-first_id, kind="stable"):  # the smallest id is written last
        d = doc[i]
        if own[i] != seq[d]:
            continue
        s, k = first[at[i] : at[i + 1]], n[at[i] : at[i + 1]]
        lo, hi = w.first[d], w.first[d + 1]
        if s[0] == WHOLE:
            places = np.arange(lo, hi)
        else:
            step = np.zeros(hi - lo + 1, np.int64)
            np.add.at(step, s, 1)
            np.add.at(step, s + k - 1 + size, -1)
            places = lo + np.flatnonzero(np.cumsum(step)[:-1])
        out[places], owner[places] = True, first_id[i]
    return out, owner


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents as ``doc_id`` and ``row`` (a struct of all their columns), each with its ``spans`` or null."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("row"))
    return own.join(spans, "doc_id", "left")
