"""Exact nearest vectors by inner product: tiles of queries and candidates, partial selection, tree merging.

Candidates are packed into tiles and dealt to shards of about ``SHARD`` tiles; the queries, packed into
blocks, are sent to every shard. A merge join holds a shard's tiles and passes the blocks by them, one after the
other and unsorted, so no pair is ever sorted or shuffled. A task multiplies one block with one tile at a time
and keeps each query's best so far; its memory is a shard's tiles, a block and the block's lists. The lists of
the shards are merged ``FAN`` at a time.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardbook.llm.scratch import stored

TILE, BLOCK, SHARD, FAN = 4096, 512, 32, 16
_EXACT = 1 << 53


def usable(vector: Column) -> Column:
    """Not null, not empty, and all components finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x.cast("double")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def _pack(scale: int, most: int):
    """Rows (vec_id, vector) into rows of up to ``most`` whole-number vectors of one length, by vec_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), batch.column(1)
            sizes = vectors.value_lengths().to_numpy()
            values, at = vectors.flatten().to_numpy(), np.append(0, np.cumsum(sizes))
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                rows = rows[np.argsort(ids[rows], kind="stable")]
                for first in range(0, len(rows), most):
                    own = rows[first : first + most]
                    data = np.floor(scale * values[at[own][:, None] + np.arange(size)].astype(np.float64))
                    yield pa.RecordBatch.from_pydict(
                        {"size": pa.array([int(size)], pa.int32()), "number": pa.array([number], pa.int32()), "ids": [ids[own].astype(np.int64).tobytes()], "data": [data.tobytes()]},
                        schema=pa.schema([("size", pa.int32()), ("number", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())]),
                    )
                    number += 1

    return run


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two matrices of whole numbers."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] < _EXACT:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest of each row of ``scores``, ties to the smaller id, of columns named by ``ids``
    (one list for all rows or one for each); best first."""
    ids = np.broadcast_to(ids, scores.shape)
    if scores.shape[1] > 4 * k:
        # Whatever is over the k-th score, and of those equal to it the smallest ids.
        cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
        rank = np.where(scores > cut, 0, np.where(scores == cut, 1, 2)).astype(np.int8)
        if (np.diff(ids[0]) >= 0).all():
            # Ids rise along the row, so a stable order by rank takes the smallest ids.
            equal = np.cumsum(rank == 1, axis=1)
            keep = (rank == 0) | ((rank == 1) & (equal <= k - (rank == 0).sum(axis=1)[:, None]))
            column = np.nonzero(keep)[1].reshape(len(scores), k)
            ids, scores = np.take_along_axis(ids, column, 1), np.take_along_axis(scores, column, 1)
    # Not -scores: the least number, which marks a query's own row, is its own negative.
    order = np.lexsort((ids, ~scores), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


_NONE = np.iinfo(np.int64).min


def _search(k: int):
    """Rows of (shard, block, ids and data of block and tile): each query's best of the shard. The join brings
    the rows of a block together; if they came apart, a query would have several lists of one shard, which the
    merging takes as well."""

    def lists(shard, queries, ids, scores):
        keep = scores > _NONE
        rows = np.nonzero(keep)[0]
        cols = [np.full(len(rows), shard), queries[rows], ids[keep], scores[keep]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["shard", "query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, queries, ids, scores, matrix = None, None, None, None, None
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names)}
                key = row["shard"], row["size"], row["block"]
                if key != at:
                    if at is not None:
                        yield lists(at[0], queries, ids, scores)
                    at, queries = key, np.frombuffer(row["query_ids"], np.int64)
                    matrix = np.frombuffer(row["query_data"], np.float64).reshape(-1, row["size"])
                    ids, scores = (np.full((len(queries), 0), _NONE) for _ in range(2))
                own = np.frombuffer(row["ids"], np.int64)
                found = product(matrix, np.frombuffer(row["data"], np.float64).reshape(-1, row["size"]))
                found[queries[:, None] == own] = _NONE
                some_ids, some = best(own, found, k)
                ids, scores = best(np.hstack([ids, some_ids]), np.hstack([scores, some]), k)
        if at is not None:
            yield lists(at[0], queries, ids, scores)

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` best candidates.

    ``vectors`` has ``vec_id`` and ``embedding``; every component x counts as floor(scale * x), x as double.
    All rows are candidates but those with the query's own id; ties go to the smaller id. Rows without an id,
    and vectors that are null, empty, or hold a null or non-finite component, take no part. Vectors of
    different lengths don't meet. Of several queries with one id the smallest vector asks. A query with fewer
    candidates gets them all; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-vectors.count() // (SHARD * TILE)))
    own = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    packed = "size int, number int, ids binary, data binary"
    rows = own.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    # A block's name: its partition and number there.
    blocks = stored(asked.mapInArrow(_pack(scale, BLOCK), packed), "blocks")
    blocks = blocks.withColumn("block", F.xxhash64("ids")).select("size", "block", F.col("ids").alias("query_ids"), F.col("data").alias("query_data"))
    blocks = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    tiles = rows.mapInArrow(_pack(scale, TILE), packed).withColumn("shard", F.pmod(F.xxhash64("ids"), F.lit(shards)).cast("int"))
    # The left side of a merge join streams by the rows of the right one.
    pairs = blocks.join(tiles.drop("number").hint("merge"), ["shard", "size"])
    found = pairs.select("shard", "size", "block", "ids", "data", "query_ids", "query_data")
    found = found.mapInArrow(_search(k), "shard long, query_id long, vec_id long, score long")
    order = [F.desc("score"), F.asc("vec_id")]
    while shards > FAN:
        shards = -(-shards // FAN)
        found = found.withColumn("shard", F.floor(F.col("shard") / FAN))
        place = F.row_number().over(W.partitionBy("query_id", "shard").orderBy(*order))
        found = found.withColumn("rank", place).filter(F.col("rank") <= k).drop("rank")
    found = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
