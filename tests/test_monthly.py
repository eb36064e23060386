"""Batches applied month by month against the newest batch of each key over all rows."""

import random
from datetime import date, datetime, timedelta

import pytest

from wardbook.operators import monthly
from wardbook.operators.snapshots import latest_by_key

SCHEMA = "k string, n int, day date, _loaded_at timestamp"


def files(spark, path):
    return {f.split("fact_month=")[1] for f in spark.read.parquet(path).inputFiles()}


def batch(spark, rng, loaded, n=60, keys=25):
    first = date(2024, 1, 1)
    rows = []
    for i in range(n):
        key = rng.choice([None, *(f"e{k}" for k in range(keys))])
        day = rng.choice([None, *(first + timedelta(days=rng.randrange(200)) for _ in range(6))])
        rows.append((key, i, day, loaded))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_batches(spark, tmp_path, seed):
    rng = random.Random(seed)
    path, every = str(tmp_path / "fct"), None
    stamps = [None, *(datetime(2024, 7, d) for d in range(1, 6))]
    rng.shuffle(stamps)
    batches = [batch(spark, rng, stamp, rng.choice([0, 3, 60])) for stamp in stamps]
    for i, own in enumerate([*batches, batches[0], batches[3]]):
        every = own if every is None else every.unionByName(own) if i < len(batches) else every
        monthly.apply_batch(own, path, "k", "day")
        got = spark.read.parquet(path)
        assert sorted(map(str, got.select("k", "n", "day", "_loaded_at").collect())) == sorted(map(str, latest_by_key(every, "k").collect()))
        assert got.filter("fact_month IS DISTINCT FROM trunc(day, 'month')").count() == 0


def test_only_touched_months_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "fct")
    day = lambda m, d=5: date(2024, m, d)
    at = lambda d: datetime(2024, 9, d)
    rows = [("a", 1, day(1), at(1)), ("b", 2, day(2), at(1)), ("c", 3, day(3), at(1)), ("d", 4, day(3), at(1)), ("e", 5, day(4), at(1)), ("f", 6, None, at(1))]
    monthly.apply_batch(spark.createDataFrame(rows, SCHEMA), path, "k", "day")
    before = files(spark, path)
    # One event moves from February to May, another is seen again in March.
    later = spark.createDataFrame([("b", 20, day(5), at(2)), ("c", 30, day(3, 6), at(2))], SCHEMA)
    assert set(monthly.apply_batch(later, path, "k", "day")) == {day(2, 1), day(3, 1), day(5, 1)}
    after = files(spark, path)
    kept = {f for f in before if f[:7] in ("2024-01", "2024-04") or f.startswith("__HIVE")}
    assert len(kept) == 3 and kept <= after and not {f for f in after if f.startswith("2024-02")}
    assert {f for f in before if f.startswith("2024-03")}.isdisjoint(after)
    got = sorted((r.k, r.n) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1), ("b", 20), ("c", 30), ("d", 4), ("e", 5), ("f", 6)]
    # Again, and an older load of the same events: nothing changes.
    monthly.apply_batch(later, path, "k", "day")
    monthly.apply_batch(spark.createDataFrame([("b", 9, day(2), at(1))], SCHEMA), path, "k", "day")
    assert sorted((r.k, r.n) for r in spark.read.parquet(path).collect()) == got
    assert monthly.apply_batch(spark.createDataFrame([], SCHEMA), path, "k", "day") == []
