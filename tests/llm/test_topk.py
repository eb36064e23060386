"""Top-k against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardbook.llm import topk


def expected(rows, k, scale=1024, every=10):
    own = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(scale * x) for x in v]) for i, v in own]
    asked = {}
    for i, v in sorted(own):
        if i % every == 0:
            asked.setdefault(i, [math.floor(scale * x) for x in v])
    out = []
    for q, v in asked.items():
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(400)]
    out += [(1000 + i, out[5][1]) for i in range(120)] + [(2000 + i, [rng.random()] * 3) for i in range(25)]
    out += [(None, out[0][1]), (3000, None), (3010, []), (3020, [1.0] * 7 + [float("nan")]), (3030, [None] * 8), (3040, [float("inf")] * 8)]
    return out + [(7, out[7][1]), (40, out[41][1]), (5000, [1e12] * 2), (5010, [1e12, -1e12])]


@pytest.mark.parametrize("k, tile, fan", [(10, 4096, 16), (7, 16, 2)])
def test_nearest(spark, rows, monkeypatch, k, tile, fan):
    monkeypatch.setattr(topk, "FAN", fan)
    monkeypatch.setattr(topk, "TILE", tile)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows if i not in (5000, 5010)], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = sorted(tuple(r) for r in topk.nearest(df, F.col("vec_id") % 10 == 0, k).collect())
    assert got == expected([r for r in rows if r[0] not in (5000, 5010)], k)


@pytest.mark.parametrize("n", [11, 12, 40])
def test_own_row_takes_no_place_in_a_small_tile(spark, n):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(n)]
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
        got = sorted(tuple(r) for r in topk.nearest(df, F.col("vec_id") % 10 == 0, 10).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    assert got == expected(rows, 10)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.nearest(df, F.col("vec_id") % 10 == 0).count() == 0


def test_large_numbers_stay_exact():
    a, b = np.array([[2.0**31, 3.0]]), np.array([[2.0**31, 5.0]])
    assert topk.product(a, b)[0, 0] == 2**62 + 15


def test_best_with_ties():
    rng = np.random.default_rng(3)
    ids, scores = np.arange(200) * 3, rng.integers(0, 4, (20, 200))
    got_ids, got = topk.best(ids, scores, 10)
    for r in range(20):
        want = sorted(zip(-scores[r], ids))[:10]
        assert [(-s, i) for s, i in want] == list(zip(got[r], got_ids[r]))
