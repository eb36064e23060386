"""A table is all old or all new whatever becomes of a load."""

import pathlib

import pytest
from pyspark.sql import functions as F

from wardbook.sources import landing, versions


@pytest.fixture
def database(spark, tmp_path, request):
    name = "v" + str(abs(hash(request.node.name)))[:8]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(spark, lo, hi, tag="x"):
    return spark.range(lo, hi).selectExpr("id", f"'{tag}' AS tag")


def content(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def versions_of(tmp_path, table):
    return sorted(p.name for p in pathlib.Path(tmp_path, table.replace(".", "/") + ".versions").iterdir() if not p.name.startswith("."))


def test_replaced_by_one_write(spark, tmp_path, database):
    table = f"{database}.t"
    assert versions.replace_table(rows(spark, 0, 5), table)
    for k in range(1, 5):
        assert not versions.replace_table(rows(spark, k, k + 3, f"v{k}"), table)
        assert content(spark, table) == [(i, f"v{k}") for i in range(k, k + 3)]
        # The version before stays for its readers, older ones go.
        assert len(versions_of(tmp_path, table)) == 2
    assert versions.location(spark, table).endswith(versions_of(tmp_path, table)[-1])


def test_readers_of_the_version_before_go_on(spark, database):
    table = f"{database}.t"
    versions.replace_table(rows(spark, 0, 100), table)
    old = spark.table(table)
    versions.replace_table(rows(spark, 0, 3), table)
    assert old.count() == 100 and spark.table(table).count() == 3


def test_new_shape(spark, database):
    table = f"{database}.t"
    versions.replace_table(rows(spark, 0, 5), table)
    assert versions.replace_table(spark.range(3).selectExpr("'a' AS other", "id"), table)
    assert content(spark, table) == [("a", i) for i in range(3)]
    assert versions.replace_table(spark.range(2).selectExpr("'a' AS other", "string(id) AS id"), table)
    assert spark.table(table).dtypes == [("other", "string"), ("id", "string")]
    assert {t.name for t in spark.catalog.listTables(database)} == {"t"} | {t.name for t in spark.catalog.listTables() if t.isTemporary}


def test_may_read_itself(spark, database):
    table = f"{database}.t"
    versions.replace_table(rows(spark, 0, 5), table)
    versions.replace_table(spark.table(table).filter("id > 1"), table)
    assert [i for i, _ in content(spark, table)] == [2, 3, 4]


class Lost(BaseException):
    """The driver ends here."""


@pytest.mark.parametrize("write", [versions.replace_table, versions.move_in])
@pytest.mark.parametrize("shape", ["same", "new"])
@pytest.mark.parametrize("step", ["write_version", "rename", "rename 2", "_create", "SET LOCATION", "RENAME TO", "RENAME TO 2", "DROP TABLE db.t__old"])
def test_lost_at_any_step(spark, tmp_path, database, monkeypatch, write, shape, step):
    """Whichever step is the last one, the table is whole and old or new, at the latest when the next load begins."""
    table = f"{database}.t"
    old = [(i, "x") for i in range(5)]
    write(rows(spark, 0, 5), table)
    df = rows(spark, 10, 12) if shape == "same" else rows(spark, 10, 12).selectExpr("tag AS other", "id")
    new = sorted(tuple(r) for r in df.collect())
    name, _, at = step.partition(" 2") if step.endswith(" 2") else (step, "", "")
    count = {"left": 2 if step.endswith(" 2") else 1}

    def lose():
        count["left"] -= 1
        if count["left"] == 0:
            raise Lost

    if name in ("write_version", "rename", "_create"):
        real = getattr(versions, name)

        def function(*args, **kw):
            lose()
            return real(*args, **kw)

        monkeypatch.setattr(versions, name, function)
    else:
        real_sql = type(spark).sql
        words = name.replace("db.t", table)

        def sql(self, text, *args, **kw):
            if words in text:
                lose()
            return real_sql(self, text, *args, **kw)

        monkeypatch.setattr(type(spark), "sql", sql)
    lost = False
    try:
        write(df, table)
    except Lost:
        lost = True
    monkeypatch.undo()
    versions.recover(spark, table)
    assert content(spark, table) in ([new] if not lost else [old, new])
    write(df, table)
    assert content(spark, table) == new


def test_driver_lost_between_the_renames(spark, tmp_path, database):
    """The same without the clean-up that an error in a living driver brings."""
    table = f"{database}.t"
    versions.move_in(rows(spark, 0, 5), table)
    place = versions.location(spark, table)
    versions.rename(spark, place, place + "__old")
    versions.recover(spark, table)
    assert len(content(spark, table)) == 5
    versions.write_version(rows(spark, 0, 9), table)  # written, and never made the table
    assert not versions.move_in(rows(spark, 0, 2), table) and len(content(spark, table)) == 2


def test_views_follow_several_loads(spark, database):
    table = f"{database}.t"
    versions.move_in(rows(spark, 0, 5), table)
    landing.materialize(spark.table(table).select("id"), "staging.follows")
    for n in (3, 7, 2):
        versions.move_in(rows(spark, 0, n), table)
        assert spark.table("follows").count() == n and spark.table(table).count() == n
    spark.catalog.dropTempView("follows")


def test_partitions_move_with_the_table(spark, database):
    table = f"{database}.t"
    df = spark.range(100).select("id", (F.col("id") % 4).alias("part"))
    for n in (100, 30):
        got = landing.materialize(df.filter(F.col("id") < n), table, "table", "id", ["part"])
        assert got.count() == n and got.filter("part = 2").count() == len(range(2, n, 4))
    assert got.inputFiles() and "PartitionFilters: [isnotnull(part" in got.filter("part = 2")._jdf.queryExecution().executedPlan().toString()


def test_a_managed_table_is_taken_over(spark, database):
    table = f"{database}.t"
    rows(spark, 0, 5).write.saveAsTable(table)
    assert not versions.replace_table(rows(spark, 0, 2), table)
    assert content(spark, table) == [(0, "x"), (1, "x")]
