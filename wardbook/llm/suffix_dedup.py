"""Repeated passages by a sparse suffix array.

Of all suffixes only those at minimiser positions are kept: each window of words is represented by the
smallest hash among its runs of ``SEED`` words, so equal windows keep the same suffix, and neighbouring
windows mostly share one.

1. The kept suffixes are range-sorted by the name of their first ``SEED`` words over the whole corpus and each is
   compared with its neighbours; the few groups that a partition border cuts are settled by the border suffixes
   alone. Only suffixes with an equal neighbour in another document go on.
2. Of equal segments (all the words that a suffix's windows reach) one stands for all (``repeats.covered``).
3. These suffixes are range-sorted by all their words, as far as their windows reach to the right, and then by the
   words before them, the nearest first. Neighbours' common prefix lengths cut the order into intervals of suffixes
   that share so many words to the right; the same is done for the words to the left. A window is a split of ``size``
   words between left and right: suffixes in one interval on both sides match there, and the smallest document's is
   the first. Intervals that a border of a partition (or of ``HELD`` suffixes) cuts are settled together by two
   64-bit names of their windows, each named once for all the suffixes of a task that share it.

Words are compared by their 64-bit hashes.
"""

from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardbook.llm import repeats as R
from wardbook.llm import spans as S
from wardbook.llm.scratch import stored

SEED = 16
# Suffixes that a task compares at a time, unless equal seeds end them earlier.
HELD = 1 << 14
# Rows that Spark samples of a partition, three times, to find the borders of a sort whose keys are whole suffixes.
SAMPLED = 20
# Suffixes whose windows are named at a time.
NAMED = 1 << 10
_INNER, _EDGE, _LONE = 0, 1, 2
_COLUMNS = ["key", "doc_id", "segment", "seq", "first", "n"]
_SUFFIX = "key long, doc_id long, segment long, seq long, first int, n int"
_RUN = "doc_id long, seq long, first_id long, first int, n int"
_BLOCKS = (
    "block long, names array<struct<w1: long, w2: long>>, members array<struct<doc_id: long, seq: long, start: int>>, "
    "least long, last long"
)
_BLOCK = {
    "block": pa.int64(),
    "names": pa.list_(pa.struct([("w1", pa.int64()), ("w2", pa.int64())])),
    "members": pa.list_(pa.struct([("doc_id", pa.int64()), ("seq", pa.int64()), ("start", pa.int32())])),
    "least": pa.int64(),
    "last": pa.int64(),
}
_FOUND = ["doc_id", "seq", "first_id", "first", "n", *_BLOCK]


def name_windows(w: S.Words, start: np.ndarray, size: int, seed: int = SEED) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    seed = min(seed, size)
    at = np.arange(len(w) - seed + 1)
    grams = S.word_prefix(w.hash).hash(at, at + seed, 21)
    return R.range_min(grams, start, start + size - seed)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of suffixes sorted by key and document, those with an equal neighbour in another document, and
    those at the partition's ends, which may have one in the next partition.

    What is held back is one document's suffixes with one key.
    """
    held, after_equal, first_key = None, False, None

    def marked(rows: pa.RecordBatch, state: np.ndarray) -> pa.RecordBatch:
        keep = np.flatnonzero(state >= 0)
        out = rows.take(pa.array(keep))
        return pa.RecordBatch.from_arrays([*out.columns, pa.array(state[keep].astype(np.int32))], names=[*out.schema.names, "state"])

    for batch in S.giving_back(batches):
        if not len(batch):
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key, doc = (rows.column(k).to_numpy() for k in (0, 1))
        first_key = key[0] if first_key is None else first_key
        at = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
        joins = np.append(after_equal, key[at[1:]] == key[at[1:] - 1])
        equal = joins[:-1] | joins[1:]
        edge = key[at[:-1]] == first_key
        state = np.where(equal, np.where(edge, _EDGE, _INNER), np.where(edge, _LONE, -1))
        yield marked(rows.slice(0, at[-1]), np.repeat(state, np.diff(at)))
        held, after_equal = rows.slice(at[-1]), bool(joins[-1])
    if held is not None:
        yield marked(held, np.full(len(held), _EDGE if after_equal else _LONE))


def shared_runs(runs: DataFrame) -> DataFrame:
    """Suffixes (with their windows) that have an equal one in another document."""
    order = ["key", "doc_id", "first"]
    suffixes = stored(runs.select(*_COLUMNS), "suffixes")
    ranked = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(ranked.mapInArrow(_neighbours, f"{_SUFFIX}, state int"), "neighbours")
    # At most two keys for each partition of the sort.
    cut = found.filter(F.col("state") >= _EDGE).groupBy("key")
    cut = cut.agg(F.min("state").alias("state"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    cut = cut.filter((F.col("state") == _EDGE) | (F.col("a") < F.col("b"))).select("key")
    return found.filter(F.col("state") < _LONE).unionByName(found.filter(F.col("state") == _LONE).join(cut, "key")).drop("state")


def _minimisers(w: S.Words, start: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Where each window's smallest run of ``seed`` words starts, the first of equal ones."""
    if not len(start):
        return start
    at = np.arange(len(w) - seed + 1)
    order = np.argsort(S.word_prefix(w.hash).hash(at, at + seed, 21), kind="stable")
    rank = np.empty_like(order)
    rank[order] = at
    return order[R.range_min(rank, start, start + size - seed)]


def _symbols(hashes: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.Array:
    """Lists of ``n`` words as binary values, eight bytes a word, that sort like lists."""
    ends = np.append(0, np.cumsum(8 * n)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(hashes[at].astype(">u8").tobytes())])


def _suffixes(size: int, seed: int):
    """The suffixes of the runs given with each text: the words from the minimiser on and those before it (the
    nearest first), as far as the windows reach that share it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            w = S.words(t)
            doc, seq, start = R.run_windows(t, w)
            place = _minimisers(w, start, size, seed)
            new = np.ones(len(start), bool)
            new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
            at = np.flatnonzero(new)
            until = start[np.append(at, len(start))[1:] - 1] + size
            ids = t.column("doc_id")
            for k in range(0, len(at), 1 << 12):
                own, end = at[k : k + (1 << 12)], until[k : k + (1 << 12)]
                p, d = place[own], doc[own]
                right, left = end - p, p - start[own]
                cols = [_symbols(w.hash, S.ranges(p, right), right), _symbols(w.hash, -S.ranges(1 - p, left), left)]
                cols += [pa.array(c) for c in (ids[d].astype(np.int64), seq[own], (p - w.first[d]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=["right", "left", "doc_id", "seq", "place"])

    return run


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of words as rows filled up with zeros, and their lengths."""
    n = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // 8
    out = np.zeros((len(column), width), np.uint64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is not None and n.any():
        out[np.arange(width) < n[:, None]] = np.frombuffer(data.to_pybytes()[offsets[0] : offsets[-1]], ">u8")
    return out, n


def _common(rows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many words each row has in common with the row before it, from the first on."""
    out = np.zeros(len(rows), np.int64)
    equal = np.logical_and.accumulate(rows[1:] == rows[:-1], axis=1).sum(axis=1)
    out[1:] = np.minimum(equal, np.minimum(n[1:], n[:-1]))
    return out


def _runs(suffix: np.ndarray, before: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, given by their suffix and how many words they reach to its left, put in order of their starts, where
    runs of neighbours of one suffix and one ``value`` begin, and how many windows each has."""
    order = np.lexsort((-before, suffix))
    own, at, v = suffix[order], before[order], value[order]
    new = np.ones(len(order), bool)
    new[1:] = (own[1:] != own[:-1]) | (at[1:] != at[:-1] - 1) | (v[1:] != v[:-1])
    begin = np.flatnonzero(new)
    return order, begin, np.diff(np.append(begin, len(order)))


def _names(right: np.ndarray, left: np.ndarray, own: np.ndarray, before: np.ndarray, n: np.ndarray, size: int) -> list[np.ndarray]:
    """Two names each of ``n`` neighbouring windows of suffix ``own``, from the one that starts ``before`` words to its
    left on, end to end. The words of ``NAMED`` suffixes are hashed at a time."""
    width, reach = size + left.shape[1], left.shape[1]
    out, at = [np.empty(int(n.sum()), np.int64) for _ in range(2)], np.cumsum(n) - n
    turn = np.argsort(own, kind="stable")
    rows, first = np.unique(own[turn], return_index=True)
    until = np.append(first[1:], len(own))
    for k in range(0, len(rows), NAMED):
        some = rows[k : k + NAMED]
        # Every suffix's words from left to right, end to end.
        words = np.concatenate([left[some, ::-1], right[some]], axis=1).ravel()
        i = turn[first[k] : until[k + len(some) - 1]]
        start = S.ranges(np.searchsorted(some, own[i]) * width + reach - before[i], n[i])
        to = S.ranges(at[i], n[i])
        for names, p in zip(out, (S.word_prefix(words), S.other_prefix(words))):
            names[to] = p.hash(start, start + size, 3).view(np.int64)
    return out


def _lists(of: pa.Array, n: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), of)


def _compared(rows: pa.RecordBatch, size: int, seed: int, cut_before: bool, cut_behind: bool, numbers: Iterator[int]) -> Iterator[pa.RecordBatch]:
    """Runs of windows of sorted suffixes that a smaller document among them has too, and blocks of windows whose
    equals may lie beyond a border: the names of neighbouring windows, and all suffixes here that share just these."""
    right, ahead = _matrix(rows.column(0), size)
    left, behind = _matrix(rows.column(1), size - seed)
    doc, seq, place = (rows.column(k).to_numpy() for k in (2, 3, 4))
    # The order by the words to the left, and each suffix's place in it.
    order = np.lexsort(left.T[::-1]) if left.shape[1] else np.arange(len(rows))
    common_right, common_left = _common(right, ahead), _common(left[order], behind[order])
    own_left = np.empty(len(rows), np.int64)
    # A group's members are told by the sum of their marks.
    mark, inner, border = S.mix(np.arange(len(rows), dtype=np.uint64), 7), [], []
    for before in range(size - seed + 1):
        on = (size - ahead <= before) & (before <= behind)
        own_right = np.cumsum(common_right < size - before)
        own_left[order] = np.cumsum(common_left < before)
        at_border = (cut_before & (own_right == own_right[0])) | (cut_behind & (own_right == own_right[-1]))
        for found, cut in ((np.flatnonzero(on & ~at_border), False), (np.flatnonzero(on & at_border), True)):
            names, group = np.unique(own_right[found] * (len(rows) + 1) + own_left[found], return_inverse=True)
            if cut:
                members = np.zeros(len(names), np.uint64)
                np.add.at(members, group, mark[found])
                border.append((found, np.full(len(found), before), members[group]))
                continue
            first = np.full(len(names), np.iinfo(np.int64).max)
            np.minimum.at(first, group, doc[found])
            later = first[group] < doc[found]
            inner.append((found[later], np.full(int(later.sum()), before), first[group][later]))

    suffix, before, first = map(np.concatenate, zip(*inner))
    if len(suffix):
        order, begin, n = _runs(suffix, before, first)
        i = order[begin]
        own = suffix[i]
        cols = [doc[own], seq[own], first[i], (place[own] - before[i]).astype(np.int32), n.astype(np.int32)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, cols), *[pa.nulls(len(own), t) for t in _BLOCK.values()]], names=_FOUND)

    suffix, before, members = map(np.concatenate, zip(*border))
    if len(suffix):
        order, begin, n = _runs(suffix, before, members)
        i = order[begin]
        # Members of one group have their runs in common: a block each.
        by_block = np.lexsort((suffix[i], before[i], members[i]))
        i, n = i[by_block], n[by_block]
        own, before, members = suffix[i], before[i], members[i]
        new = np.append(True, (members[1:] != members[:-1]) | (before[1:] != before[:-1]))
        at = np.flatnonzero(new)
        sharing, n = np.diff(np.append(at, len(own))), n[at]
        named = pa.StructArray.from_arrays([*map(pa.array, _names(right, left, own[at], before[at], n, size))], names=["w1", "w2"])
        parts = [doc[own], seq[own], (place[own] - before).astype(np.int32)]
        held = pa.StructArray.from_arrays([*map(pa.array, parts)], names=["doc_id", "seq", "start"])
        cols = [pa.array(islice(numbers, len(at)), pa.int64()), _lists(named, n), _lists(held, sharing)]
        cols += [pa.array(f.reduceat(doc[own], at)) for f in (np.minimum, np.maximum)]
        none = [pa.nulls(len(at), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())]
        yield pa.RecordBatch.from_arrays([*none, *cols], names=_FOUND)


def _matches(size: int, seed: int, most: int):
    """Compare a partition of the sorted suffixes, up to a change of the seed or ``most`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, cut = [], True
        numbers = count(TaskContext.get().partitionId() << 33)
        for batch in S.giving_back(batches):
            parts.append(batch)
            if sum(map(len, parts)) < most:
                continue
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            new = np.flatnonzero(_common(*_matrix(rows.column(0), size))[1:] < seed) + 1
            at = int(new[-1]) if len(new) else len(rows)
            yield from _compared(rows.slice(0, at), size, seed, cut, not len(new), numbers)
            parts, cut = [rows.slice(at)] if len(new) else [], not len(new)
        if any(map(len, parts)):
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            yield from _compared(rows, size, seed, cut, True, numbers)

    return run


def extended_matches(texts: DataFrame, size: int) -> DataFrame:
    """Of the windows of the ``runs`` given with ``texts``: (doc_id, seq, first_id, first, n), those that a smaller
    document's runs have too, by the suffixes' sorted words."""
    spark, seed, order = texts.sparkSession, min(SEED, size), ["right", "left", "doc_id"]
    suffixes = texts.mapInArrow(_suffixes(size, seed), "right binary, left binary, doc_id long, seq long, place int")
    suffixes = stored(suffixes, "word_suffixes")
    key = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, SAMPLED)
    try:
        ranked = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
        found = stored(ranked.mapInArrow(_matches(size, seed, HELD), f"{_RUN}, {_BLOCKS}"), "matches")
    finally:
        spark.conf.set(key, before)
    inner = found.filter("block is null").select("doc_id", "seq", "first_id", "first", "n")
    return inner.unionByName(_across_borders(found.filter("block is not null").select(*_BLOCK)))


def _across_borders(blocks: DataFrame) -> DataFrame:
    """Of the blocks' windows, runs that a smaller document has too. A name has one row for each block, however many
    suffixes share it, and what is found for a run of names goes to all of the block's suffixes."""
    named = blocks.select("block", "least", "last", F.posexplode("names").alias("at", "name"))
    firsts = named.groupBy("name.w1", "name.w2").agg(F.min("least").alias("first_id"), F.max("last").alias("last_id"))
    firsts = firsts.filter("first_id < last_id").drop("last_id")
    hits = named.select("block", "last", "at", "name.w1", "name.w2").join(firsts, ["w1", "w2"]).filter("first_id < last")
    # Neighbours of one block and first document differ as much in their places as in their numbers.
    numbered = F.row_number().over(W.partitionBy("block", "first_id").orderBy("at"))
    runs = hits.withColumn("run", F.col("at") - numbered).groupBy("block", "first_id", "run")
    runs = runs.agg(F.min("at").alias("at"), F.count("*").cast("int").alias("n")).drop("run")
    members = runs.join(blocks.select("block", "members"), "block").select("first_id", "at", "n", F.inline("members"))
    return members.filter("first_id < doc_id").select("doc_id", "seq", "first_id", (F.col("start") + F.col("at")).alias("first"), "n")


def repeated_spans(docs: DataFrame, size: int = R.WINDOW) -> DataFrame:
    """Per document that repeats a passage of a document with a smaller id: its spans."""
    marks = R.mark(docs, name_windows, size)
    placed = R.placed(marks)
    return R.covered(docs, placed, shared_runs(R.original_runs(marks, placed)), size, extended_matches)


def repeated_passages(docs: DataFrame, size: int = R.WINDOW) -> DataFrame:
    """One row per stretch of words that repeats earlier documents: ``doc_id``, ``first_word`` (from 0),
    ``n_words``, ``first_doc_id`` (an earlier document with a window of it; for an exact copy, the smallest id
    with the same words) and ``passage``.

    The words are those of any ``size`` consecutive words that also occur in a document with a smaller id.
    Words end at ASCII white space. Null, empty and shorter texts have no passages; rows without an id take
    no part; rows of one id don't repeat each other; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            w = S.words(t)
            cover, owner = R.cover_mask(w, t, size)
            doc = w.doc()
            begins = cover.copy()
            begins[1:] &= ~cover[:-1] | (doc[1:] != doc[:-1])
            at = np.flatnonzero(begins)
            n = np.add.reduceat(cover, at, dtype=np.int64) if len(at) else at
            first_id = np.minimum.reduceat(owner, at) if len(at) else at
            ids = t.column("doc_id").astype(np.int64)[doc[at]] if len(at) else at
            text = [t.data[w.start[a] : w.end[a + k - 1]].tobytes().decode() for a, k in zip(at, n)]
            cols = [ids, (at - w.first[doc[at]] if len(at) else at), n, first_id]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols], pa.array(text, pa.string())], names=["doc_id", "first_word", "n_words", "first_doc_id", "passage"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(repeated_spans(docs, size), "doc_id")
    return rows.mapInArrow(run, "doc_id long, first_word long, n_words long, first_doc_id long, passage string")


def without_repeats(docs: DataFrame, size: int = R.WINDOW) -> DataFrame:
    """``docs`` with the passages of ``repeated_passages`` cut out of ``text``, each word with the white
    space after it; ``n_chars``, if there is such a column, follows. All rows and columns stay, a text that
    repeats nothing stays as it is, and a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            w = S.words(t)
            cover, _ = R.cover_mask(w, t, size)
            gone = np.flatnonzero(cover)
            until = np.append(w.start, len(t.data))[1:]
            until = np.minimum(until, t.offsets[1:][w.doc()]) if len(w) else until
            keep = np.ones(len(t.data), bool)
            keep[S.ranges(w.start[gone], until[gone] - w.start[gone])] = False
            size_now = S.segment_sums(keep, t.offsets)
            data = pa.py_buffer(t.data[keep].tobytes())
            ends = pa.py_buffer(np.append(0, np.cumsum(size_now)).astype(np.int32).tobytes())
            text = pa.StringArray.from_buffers(len(t), ends, data)
            yield pa.RecordBatch.from_arrays([t.rows.column(t.rows.schema.get_field_index("row")), text], names=["row", "new"])

    rows = R.with_spans(docs, repeated_spans(docs, size)).drop("doc_id")
    schema = docs.select(F.struct("*").alias("row"), F.lit("").alias("new")).schema
    cut = rows.mapInArrow(run, schema)
    old = {c: F.col("row").getField(c) for c in docs.columns}
    new = {"text": F.when(old["text"].isNotNull(), F.col("new"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(old["text"] == F.col("new"), old["n_chars"]).otherwise(F.length("new")).cast(docs.schema["n_chars"].dataType)
    return cut.select(*[new.get(c, old[c]).alias(c) for c in docs.columns])
