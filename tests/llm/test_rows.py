"""Stages keep rows and columns whatever the columns are called and however often an id occurs."""

import random

import pytest

from wardbook.llm import knn_quality, ngram_join, packing, quality_rules, recompression, suffix_dedup
from wardbook.llm.knn_quality import Model

SCHEMA = "doc_id long, text string"


def words(rng, n):
    return " ".join(f"w{rng.randrange(3000)}" for _ in range(n))


@pytest.fixture(scope="module")
def clashing(spark):
    rng = random.Random(8)
    t, u = words(rng, 80), words(rng, 80)
    rows = [(1, t), (5, t), (5, u), (6, u + " z"), (7, words(rng, 30)), (None, t), (8, None), (9, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.selectExpr(
        "doc_id", "text", "'en' AS lang", "1 AS _gone_id", "2 AS gone", "3 AS `a``b`", "4 AS row", "5 AS spans", "6 AS set_id", "7 AS whole", "8 AS score",
        "9 AS kept", "'x' AS `d.e`",
    )


def test_one_per_group_by_text(clashing):
    out = ngram_join.one_per_group(clashing)
    assert out.dtypes == clashing.dtypes
    first = {r.text: r.doc_id for r in clashing.collect()[::-1] if r.doc_id is not None}
    got = sorted((r.doc_id or 0, r.text or "") for r in out.collect())
    t, u = (next(r.text for r in clashing.collect() if (r.doc_id, first.get(r.text)) == k) for k in ((1, 1), (5, 5)))
    # The text of 5 that links lead from to 1 goes, its other text stays, and 6 goes for that one.
    assert got == sorted([(1, t), (5, u), (7, next(r.text for r in clashing.collect() if r.doc_id == 7)), (0, t), (8, ""), (9, "")])


@pytest.mark.parametrize("stage", [quality_rules.kept, suffix_dedup.without_repeats, ngram_join.one_per_group])
def test_stages_return_their_columns(clashing, stage):
    out = stage(clashing)
    assert out.dtypes == clashing.dtypes
    assert {tuple(r[3:]) for r in out.collect()} == {(1, 2, 3, 4, 5, 6, 7, 8, 9, "x")}


def test_classifier_returns_its_columns(spark, clashing):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    out = knn_quality.kept(clashing, labels, limit=0.0)
    assert out.dtypes == clashing.dtypes and out.count() == 8


def test_equal_cosines_are_taken_in_order():
    """Copies in the sample tie; which of them vote does not depend on the block."""
    import numpy as np

    rng = np.random.default_rng(0)
    v = rng.standard_normal((1, 48)).astype(np.float32)
    v /= np.linalg.norm(v)
    labels = (np.arange(200) < 10).astype(float)
    m = Model(np.ones(knn_quality.TERMS, np.float32), np.eye(knn_quality.TERMS, 48, dtype=np.float32), np.repeat(v, 200, axis=0), labels, 0.5)
    counts = np.zeros((300, knn_quality.TERMS), np.float32)
    counts[:, 0] = rng.random(300)
    scores = m.scores(counts)
    assert np.allclose(scores, 10 / knn_quality.NEIGHBOURS) and len(set(m.scores(counts[:7]))) == 1


@pytest.fixture(scope="module")
def long_texts(spark):
    rng = random.Random(1)
    a, b = words(rng, 9_000), words(rng, 9_000)
    one = "y" * 300_000
    rows = [(1, a), (2, f"{b} {a}"), (3, f"{a} tail"), (4, one), (5, f"{one} {one}"), (6, one)]
    return spark.createDataFrame(rows, SCHEMA)


def test_long_texts(spark, long_texts):
    removed = {r.doc_id: (r.n_words, r.n_removed) for r in recompression.digest(long_texts).collect()}
    assert removed == {1: (9_000, 0), 2: (18_000, 9_000), 3: (9_001, 9_000), 4: (1, 0), 5: (2, 0), 6: (1, 0)}
    found = sorted((r.doc_id, r.first_word, r.n_words) for r in suffix_dedup.repeated_passages(long_texts).collect())
    assert found == [(2, 9_000, 9_000), (3, 0, 9_000)]
    got = {r.doc_id: r.component_id for r in ngram_join.joined(long_texts, n=4, percent=85).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5, 6: 4}
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    assert knn_quality.judged(long_texts, labels).filter("score between 0 and 1").count() == 6


def test_long_text_is_packed_whole(long_texts):
    import public_tokenizers

    pieces = packing.packed(long_texts.filter("doc_id = 2"), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted(r.start for r in pieces)[1:] == sorted(r.start + r.length for r in pieces)[:-1]
