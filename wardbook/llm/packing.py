"""Packing tokenized documents into sequences by vector best fit.

A piece needs tokens, one place in the sequence's document count, and attention cost (the square of its
length). Pieces are dealt at random to groups of about ``GROUP``, whose number follows the data; within one,
the longest piece comes first and goes to the open sequence that fits every capacity and that it leaves with
the smallest weighted residual (``norm``), or whose residual has the largest weighted dot product with it
(``dot``). A group wastes at most about one sequence more than packing all of them together.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardbook.llm import spans as S
from wardbook.llm.byte_bpe import Memory, Vocabulary, byte_letters, values_of
from wardbook.llm.scratch import stored

GROUP = 16384


@dataclass(frozen=True)
class Capacity:
    """Of one sequence. The defaults of documents and cost bind nothing that tokens don't."""

    tokens: int = 1024
    documents: int = 1024
    cost: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    rule: str = "norm"


@lru_cache(2)
def _encoder(path: str) -> tuple[Vocabulary, Memory]:
    """A worker's vocabulary and its memory of identifiers, which the library's model makes."""
    vocabulary, letters = Vocabulary(path), dict(enumerate(byte_letters()))
    model = Tokenizer.from_file(path).model
    ids = lambda raw: [x.id for x in model.tokenize(raw.decode("latin-1").translate(letters))]
    return vocabulary, Memory(ids)


def identifiers(t: S.Texts, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The library's identifiers of the documents, end to end, and where each document's start."""
    vocabulary, memory = _encoder(path)
    at, length, first = values_of(t, vocabulary, memory, lambda i: i)
    ends = np.append(0, np.cumsum(length))
    return memory.values[S.ranges(at, length.astype(np.int64))], ends[first]


def _cut(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 33
        for t in S.texts(batches):
            ids, first = identifiers(t, path)
            size = np.diff(first) + 1
            whole = np.insert(ids, first[1:], end_id).astype("<u4")
            begin = np.append(0, np.cumsum(size))
            n = -(-size // capacity)
            doc = np.repeat(np.arange(len(t)), n)
            piece = S.ranges(np.zeros(len(n), np.int64), n)
            head = size - (n - 1) * capacity  # the first piece has what is over
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[doc], capacity)
            a = begin[doc] + start
            crc = [zlib.crc32(whole[x : x + k]) for x, k in zip(a.tolist(), length.tolist())]
            cols = {
                "key": pa.array(made + np.arange(len(doc))), "doc_id": t.rows.column(0).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
            }
            if keep_ids:
                cols["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(whole.astype(np.int32)))
            made += len(doc)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def tokenized(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with a ``key`` each; stored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "key long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return stored(rows.mapInArrow(_cut(path, capacity, end_id, keep_ids), schema), "pieces")


def best_fit(length: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of pieces given by their lengths."""
    if capacity.rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {capacity.rule}")
    cap = np.array([capacity.tokens, capacity.documents, capacity.cost], float)
    weights = np.array(capacity.weights)
    need = np.stack([length, np.ones(len(length)), length.astype(float) ** 2], axis=1)
    if len(need) and (need > cap).any():
        raise ValueError("a piece is over the capacity of an empty sequence")
    number, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    order = np.argsort(-length, kind="stable")
    least = need.min(axis=0) if len(need) else cap
    left, names, used, n_open, made = np.empty((1024, 3)), np.empty(1024, np.int64), np.empty(1024, np.int64), 0, 0
    closed = 0
    for i in order:
        own, room = need[i], left[:n_open]
        at = -1
        fits = np.flatnonzero((room[:, 0] >= own[0]) & (room[:, 1] >= own[1]) & (room[:, 2] >= own[2]))
        if len(fits):
            if capacity.rule == "norm":
                at = fits[np.argmin((((room[fits] - own) / cap) ** 2) @ weights)]
            else:
                at = fits[np.argmax((room[fits] / cap) @ (weights * own / cap))]
        else:
            if n_open == len(left):
                left, names, used = (np.concatenate([x, np.empty_like(x)]) for x in (left, names, used))
            at, n_open = n_open, n_open + 1
            left[at], names[at], used[at], made = cap, made, 0, made + 1
        number[i], offset[i] = names[at], used[at]
        left[at] -= own
        used[at] += int(length[i])
        closed += bool((left[at] < least).any())
        if closed * 4 > n_open:  # sequences that nothing fits any more are set aside now and then
            keep = np.flatnonzero((left[:n_open] >= least).all(axis=1))
            n_open, closed = len(keep), 0
            left[:n_open], names[:n_open], used[:n_open] = left[keep], names[keep], used[keep]
    return number, offset


def placed(pieces: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """The pieces with ``sequence_id`` (any numbers) and ``offset``, gapless from 0 in each sequence."""
    groups = max(1, ceil(pieces.count() / GROUP))

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("key")
        number, offset = best_fit(rows["length"].to_numpy(), capacity)
        rows = rows.append_column("sequence_id", pa.array((key[0].as_py() << 32) + number))
        return rows.append_column("offset", pa.array(offset)).drop_columns(["group_number"])

    dealt = pieces.withColumn("group_number", F.pmod(F.xxhash64("key"), F.lit(groups)))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("group_number").applyInArrow(pack, f"{columns}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str, capacity: Capacity = Capacity(), end_id: int = 2) -> DataFrame:
    """Per piece of ``docs`` (``doc_id`` and ``text`` are used): ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32`` (of its identifiers as little-endian unsigned 32-bit numbers), ``sequence_id``, ``offset``.

    A document is its identifiers under the vocabulary file ``path`` (which every worker must have), without
    special tokens added, and then ``end_id``. Only a longer one than a sequence is cut, and only its first
    piece is shorter than a sequence. A null or empty text is the end alone; equal rows are each packed; an
    empty table gives no rows.
    """
    return placed(tokenized(docs, path, capacity.tokens, end_id), capacity).drop("key")


def sequences(docs: DataFrame, path: str, capacity: Capacity = Capacity(), end_id: int = 2) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` and the ``doc_ids`` in their order."""
    pieces = tokenized(docs, path, capacity.tokens, end_id, keep_ids=True)
    where = placed(pieces.drop("ids"), capacity).select("key", "sequence_id", "offset")
    rows = pieces.join(where, "key").groupBy("sequence_id")
    rows = rows.agg(F.sort_array(F.collect_list(F.struct("offset", "key", F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "ids"))).alias("parts"))
    return rows.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
