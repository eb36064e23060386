import datetime as dt

import pytest

from wardbook.operators import quality as q


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, "a", -1), (1, "b", 0), (2, "z", None), (None, None, 3), (None, None, 3)]
    return spark.createDataFrame(rows, "k int, v string, n int")


@pytest.fixture(scope="module")
def good(spark):
    return spark.createDataFrame([(1, "a", 0), (2, "b", 5)], "k int, v string, n int")


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_not_null(df, good):
    assert q.not_null(df, "k").count() == 2 and q.not_null(good, "k").count() == 0


def test_unique_ignores_nulls(df, good):
    assert rows(q.unique(df, "k")) == [(1, 2)] and rows(q.unique(good, "k")) == []


def test_unique_combination_counts_nulls(df, good):
    assert rows(q.unique_combination(df, ["k", "v"])) == [(None, None, 2)] and rows(q.unique_combination(good, ["k", "v"])) == []


def test_accepted_values(df, good):
    assert rows(q.accepted_values(df, "v", ["a", "b"])) == [("z", 1)] and rows(q.accepted_values(good, "v", ["a", "b"])) == []


def test_relationships(spark, df, good):
    parent = spark.createDataFrame([(2,), (3,), (3,)], "id int")
    assert rows(q.relationships(df, "k", parent, "id")) == [(1, 2)]
    assert rows(q.relationships(good, "k", good, "k")) == []


def test_non_negative(df, good):
    assert rows(q.non_negative(df, "n")) == [(1, "a", -1)] and q.non_negative(good, "n").count() == 0


def test_plausible(df, good):
    assert q.plausible(df, "n", 2).count() == 2 and q.plausible(good, "n", 5).count() == 0


def test_no_future(spark):
    today = dt.date(2026, 1, 2)
    frame = spark.createDataFrame([(today, None), (today, dt.date(2026, 1, 3)), (None, None)], "a date, b date")
    assert q.no_future(frame, ["a", "b"], today).count() == 1


@pytest.mark.parametrize("hours, status", [(48, "pass"), (49, "warn"), (168, "warn"), (169, "error")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2026, 1, 10, tzinfo=dt.timezone.utc)
    frame = spark.createDataFrame([(now - dt.timedelta(hours=hours),)], "_loaded_at timestamp")
    assert q.freshness(frame, now).first().status == status
    assert q.freshness(frame.limit(0), now).first().status == "error"


def test_suite_has_the_declared_counts():
    suite = q.declared_checks(dt.date(2026, 1, 1))
    kinds = [c.kind for c in suite]
    assert len(suite) == 41
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 18,
        "unique": 11,
        "accepted_values": 2,
        "relationships": 3,
        "non_negative": 3,
        "unique_combination": 2,
        "no_future": 1,
        "plausible": 1,
    }


def test_run_checks_and_gate(spark, df, good):
    suite = [
        q.Check("t", "not_null", ("k",)),
        q.Check("t", "non_negative", ("n",)),
        q.Check("t", "unique", ("k",)),
        q.Check("t", "accepted_values", ("v",), {"values": ["a", "b"]}),
        q.Check("t", "relationships", ("k",), {"parent": "p", "parent_key": "k"}),
        q.Check("t", "unique_combination", ("k", "v")),
    ]
    failing = q.run_checks({"t": df, "p": good.filter("k = 2")}, suite)
    assert [r.n_failed for r in failing.orderBy("check_name").collect()] == [1, 1, 2, 2, 1, 1]
    with pytest.raises(RuntimeError, match=r"not_null\(t: k\) 2"):
        q.require_passing(failing)
    q.require_passing(q.run_checks({"t": good, "p": good}, suite))
