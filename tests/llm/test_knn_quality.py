"""The voting classifier: plain cosines, held-out accuracy, and rows without use."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from wardbook.llm import knn_quality as knn
from wardbook.llm import spans


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = []
    for i in range(500):
        w = ["".join(rng.choice(["th", "er", "on", "an"]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 90))]
        bad = rng.random() < 0.3
        style = rng.randrange(3)
        if bad:
            w = [x + "***" for x in w] if style == 0 else [x.upper() + "!!" for x in w] if style == 1 else [x for x in w for _ in range(6)]
        out.append((i, " ".join(w), 0 if bad else 1))
    return out


def test_held_out_accuracy(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").selectExpr("*", "doc_id % 7 AS score", "'x' AS row")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    got = {r.doc_id: r for r in knn.judged(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    right = [got[i].predicted == q for i, _, q in rows if got[i].held_out]
    assert len(right) > 60 and sum(right) / len(right) > 0.97
    kept = knn.kept(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    # Labels of held-out rows are never read.
    changed = spark.createDataFrame([(i, 1 - q if got[i].held_out else q) for i, _, q in rows], "doc_id long, quality int")
    assert {r.doc_id: r.score for r in knn.judged(docs, changed).collect()} == {i: r.score for i, r in got.items()}


def test_scores_are_plain_votes(rows):
    t = next(spans.texts([pa.RecordBatch.from_pydict({"text": [r[1] for r in rows[:200]]})]))
    counts, labels = knn.term_counts(t), np.array([r[2] for r in rows[:200]], float)
    model = knn.fit_arrays(counts[:100], labels[:100])
    got = model.scores(counts[100:])
    for c, s in zip(counts[100:], got):
        v = model.vectors_of(c[None])[0]
        cosine = model.vectors @ v
        near = np.argsort(-cosine)[: knn.NEIGHBOURS]
        vote = np.maximum(cosine[near], 1e-3).astype(float) ** knn.SHARPNESS
        assert s == pytest.approx((vote * model.labels[near]).sum() / vote.sum(), abs=1e-4)


def test_terms_stay_in_their_document():
    texts = ["abcd abcd", "", "ab", "abcd abcd", None, "x"]
    t = next(spans.texts([pa.RecordBatch.from_pydict({"text": texts})]))
    counts = knn.term_counts(t)
    alone = [knn.term_counts(next(spans.texts([pa.RecordBatch.from_pydict({"text": pa.array([x], pa.string())})])))[0] for x in texts]
    assert np.allclose(counts, np.array(alone)) and not counts[1].any() and not counts[4].any()


def test_rows_without_use(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 0)], "doc_id long, quality int")
    docs = spark.createDataFrame([(1, "some text"), (1, "some text"), (None, "other"), (3, None), (4, "")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.score, r.predicted) for r in knn.judged(docs, labels).collect())
    assert [g[1:] for g in got] == [(0.5, 1)] * 5
    assert knn.judged(docs, labels.limit(0)).count() == 5
    assert knn.judged(docs.limit(0), labels).count() == 0
