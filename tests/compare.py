"""Run registered queries against their SQL in DuckDB: ``python tests/compare.py [sf_dir] [name ...]``."""

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimal in a compared result")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def difference(df, con, sql):
    """None when names and values agree, else a short account of the first difference."""
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_names, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} / {sorted(want_names)}"
    a, b = rows(got_names, got), rows(want_names, want)
    if len(a) != len(b):
        extra = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
        return f"rows {len(a)} / {len(b)}: {extra}"
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(got_names)}\n   {x}\n   {y}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from conftest import session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                fault = difference(df, con, oracles[name])
                n = ""
            else:
                fault, n = None, f"{len(df.collect())} rows only"
        except Exception as e:
            fault, n = f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += fault is not None
        print(f"{'FAIL' if fault else 'ok  '} {name} {time.time() - start:.2f}s {n} {fault or ''}", flush=True)
    print("failures:", bad)
