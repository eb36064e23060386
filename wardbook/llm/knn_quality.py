"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms are hashed runs of three bytes, runs of four character shapes (any letter is one shape, any sign its
own) and how soon words come again. Documents become log-scaled, inverse-frequency weighted term vectors,
which a singular value decomposition of a bounded sample of labelled documents projects to few dimensions.
The sample's vectors are broadcast; each document's cosines with all of them are exact, in blocks, and its
``NEIGHBOURS`` nearest vote with their labels, weighted by similarity.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.llm import spans as S

# Bound of the labelled sample: so many rows of each label, the first by a hash of the id.
SAMPLE_PER_LABEL = 1500
DIMENSIONS, NEIGHBOURS, SHARPNESS = 48, 25, 8
# Cosines count in steps of this fraction.
STEPS = 1 << 16
_BYTE_TERMS, _SHAPE_TERMS, _GAPS = 2048, 1024, 8
TERMS = _BYTE_TERMS + _SHAPE_TERMS + _GAPS

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 97, 65, 48, 97


def _grams(values: np.ndarray, n: int, terms: int) -> np.ndarray:
    """A term (of a power of two) for each place, of the ``n`` bytes that start there."""
    padded = np.append(values, np.zeros(4, np.uint8)).astype(np.uint32)
    code = padded[: len(values)].copy()
    for k in range(1, n):
        code |= padded[k : k + len(values)] << np.uint32(8 * k)
    # Multiplicative hashing: the high bits of a product with an odd number.
    return (code * np.uint32(2654435761)) >> np.uint32(33 - terms.bit_length())


def term_counts(t: S.Texts) -> np.ndarray:
    """A row of term frequencies for each document."""
    parts = []
    size = np.diff(t.offsets)
    for values, n, terms in ((t.data, 3, _BYTE_TERMS), (_SHAPE[t.data], 4, _SHAPE_TERMS)):
        bins = _grams(values, n, terms)
        # The last places of a document have no whole run and are left out as one further bin.
        places = np.arange(len(bins)) + n > np.repeat(t.offsets[1:], size)
        parts.append(S.histogram(t, np.where(places, terms, bins), terms + 1)[:, :terms])
    w = S.words(t)
    doc = w.doc()
    gap = np.full(len(w), _GAPS)
    for k in range(_GAPS - 1, 0, -1):
        gap[k:][(w.hash[k:] == w.hash[:-k]) & (doc[k:] == doc[:-k])] = k - 1
    parts.append(S.histogram(t, gap, _GAPS + 1, w.first)[:, :_GAPS])
    return np.hstack([p / np.maximum(1, n)[:, None] for p, n in zip(parts, (size, size, w.counts))]).astype(np.float32)


def _scaled(counts: np.ndarray) -> np.ndarray:
    return np.log1p(1000 * counts)


@dataclass
class Model:
    weights: np.ndarray  # of the terms
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # of the sample, normed
    labels: np.ndarray
    prior: float

    def vectors_of(self, counts: np.ndarray) -> np.ndarray:
        v = (_scaled(counts) * self.weights) @ self.axes
        return v / np.maximum(1e-12, np.linalg.norm(v, axis=1, keepdims=True))

    def scores(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        full = np.flatnonzero(counts.any(axis=1))
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for first in range(0, len(full), 256):
            own = full[first : first + 256]
            # Rounded, so that a block's rounding decides nothing; of equal ones the first of the sample count.
            cosine = np.rint((self.vectors_of(counts[own]) @ self.vectors.T).astype(np.float64) * STEPS).astype(np.int64)
            order = cosine * cosine.shape[1] - np.arange(cosine.shape[1])
            near = np.sort(np.argpartition(order, order.shape[1] - k, axis=1)[:, -k:], axis=1)
            vote = np.maximum(np.take_along_axis(cosine, near, 1) / STEPS, 1e-3) ** SHARPNESS
            out[own] = (vote * self.labels[near]).sum(axis=1) / vote.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def _axes(x: np.ndarray) -> np.ndarray:
    """The first right singular vectors of a sample, as columns, by subspace iteration: its memory is the
    sample's."""
    q = np.random.default_rng(0).standard_normal((TERMS, DIMENSIONS + 16)).astype(np.float32)
    for _ in range(8):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, turn = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ turn.T)[:, :DIMENSIONS]


def fit_arrays(counts: np.ndarray, labels: np.ndarray) -> Model:
    """The model of a sample's term frequencies and labels (shares of 1)."""
    prior = float(labels.mean()) if len(labels) else 0.5
    used = counts.any(axis=1)
    x, y = _scaled(counts[used]), labels[used]
    weights = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 0.1 if len(x) else np.ones(TERMS, np.float32)
    x *= weights
    axes = _axes(x)
    v = x @ axes
    return Model(weights, axes, v / np.maximum(1e-12, np.linalg.norm(v, axis=1, keepdims=True)), y, prior)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from learning."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in S.texts(batches):
        yield S.with_column(t.rows, terms=pa.array([r.tobytes() for r in term_counts(t)], pa.binary()))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """From at most ``SAMPLE_PER_LABEL`` documents of each label that are not held out. A document with
    several labels counts with their mean."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    known = known.filter("doc_id is not null and quality is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.join(ids, "doc_id", "left_semi")
    # Each task's first ones, then the first of those: no task gets all labelled rows.
    first = lambda rows: rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_LABEL)
    sample = first(known.filter("quality >= 0.5")).unionByName(first(known.filter("quality < 0.5")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    rows = texts.mapInArrow(_terms, "doc_id long, quality double, terms binary").dropDuplicates(["doc_id", "terms"])
    rows = sorted(rows.collect(), key=lambda r: (r.doc_id, bytes(r.terms)))  # bounded by the sample
    counts = np.array([np.frombuffer(r.terms, np.float32) for r in rows]).reshape(-1, TERMS)
    return fit_arrays(counts, np.array([r.quality for r in rows], float))


def scored(docs: DataFrame, labels: DataFrame, columns: list[Column | str], schema: str) -> DataFrame:
    """Of every document the ``columns``, which hold its text, as ``schema`` has them, and its ``score``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            yield S.with_column(t.rows, score=model.value.scores(term_counts(t)).astype(np.float64))

    return docs.select(*columns).mapInArrow(run, schema)


def judged(docs: DataFrame, labels: DataFrame, limit: float = 0.3) -> DataFrame:
    """Per row of ``docs`` (``doc_id`` and ``text`` are used): ``doc_id``, ``held_out``, ``score`` (0 to 1,
    the neighbours' share of label 1) and ``predicted`` (1 from ``limit`` on).

    A null or empty text, and any text where there are no labels, has the sample's mean label as its score
    (0.5 without labels). A null id is not held out. Equal texts have equal scores; an empty table gives no
    rows.
    """
    rows = scored(docs, labels, [F.col("doc_id").cast("long").alias("doc_id"), "text"], "doc_id long, score double")
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return rows.select("doc_id", out, "score", F.when(F.col("score") >= limit, 1).otherwise(0).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, limit: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that ``judged`` predicts 1 for, with all their columns."""
    row = docs.select(F.struct("*").alias("row"))
    schema = row.withColumn("score", F.lit(0.0)).schema
    rows = scored(docs, labels, [F.struct("*").alias("row")], schema).filter(F.col("score") >= limit)
    return rows.select("row.*")
