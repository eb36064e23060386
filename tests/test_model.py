import datetime as dt
import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wardbook.operators import features, metrics, model, score
from wardbook.schema import FEATURES
from wardbook.sources import sinks, weather

FORECAST = "hour timestamp_ntz, temperature_2m double, precipitation double, snowfall double, wind_speed_10m double"
HOUR = dt.datetime(2026, 9, 22, 8)


class FixedModel:
    def transform(self, df):
        return df.withColumn("probability", array_to_vector(F.array(F.lit(0.7), F.lit(0.3))))


def brute_force(scored):
    pos, neg = [p for p, y in scored if y], [p for p, y in scored if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, hits, seen = 0.0, 0, 0
    for s in sorted({p for p, _ in scored}, reverse=True):
        group = [y for p, y in scored if p == s]
        hits, seen = hits + sum(group), seen + len(group)
        ap += sum(group) / len(pos) * hits / seen
    return auc, ap, sum((p - y) ** 2 for p, y in scored) / len(scored)


@pytest.mark.parametrize("digits, n, per_bucket", [(1, 300, 65_536), (6, 900, 130), (0, 40, 10), (6, 900, 4)])
def test_metrics_match_brute_force(spark, digits, n, per_bucket):
    rng = random.Random(digits)
    scored = [(round(rng.random(), digits) if digits else 0.5, int(rng.random() < 0.3)) for _ in range(n)]
    df = spark.createDataFrame(scored, "p double, any_delay_5min int")
    row = metrics.evaluate(df, per_bucket=per_bucket).first()
    assert (row.roc_auc, row.pr_auc, row.brier) == pytest.approx(brute_force(scored))
    assert metrics.brier(df).first()[0] == pytest.approx(row.brier)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(row.roc_auc)


def test_several_frames_share_a_curve(spark):
    rng = random.Random(11)
    frames = {n: [(round(rng.random(), d), int(rng.random() < 0.4)) for _ in range(k)] for n, d, k in (("a", 1, 200), ("b", 6, 500), ("c", 3, 1))}
    dfs = {n: spark.createDataFrame(rows, "p double, any_delay_5min int") for n, rows in frames.items()}
    dfs["empty"] = dfs["a"].filter("p > 2")
    got = {r.model: (r.roc_auc, r.pr_auc, r.brier) for r in metrics.evaluate_each(dfs, per_bucket=60).collect()}
    assert set(got) == {"a", "b", "c"} and got["c"][0] is None
    for n in "ab":
        assert got[n] == pytest.approx(brute_force(frames[n]))
    split = spark.sql("SELECT timestamp_ntz'2026-03-01 00:00:00' AS split_at")
    row = metrics.metrics_row(dfs["a"], dfs["b"], split, dfs, "now").first()
    assert (row.rows_train, row.rows_test, row.test_from) == (200, 500, "2026-03-01")
    assert row.b.asDict() == {m: round(x, 4) for m, x in zip(("roc_auc", "pr_auc", "brier"), brute_force(frames["b"]))}
    assert row.empty.asDict() == {"roc_auc": None, "pr_auc": None, "brier": None}


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)], "p double, any_delay_5min int")
    row = metrics.evaluate(df).first()
    assert row.roc_auc == 0.75 and row.pr_auc == pytest.approx(0.5 + 0.5 * 2 / 3)
    assert metrics.evaluate(df.filter("any_delay_5min = 1")).first().roc_auc is None


def requests(spark, *rows):
    return spark.createDataFrame(rows, "line string, at timestamp_ntz, weather string")


@pytest.fixture(scope="module")
def forecast(spark):
    rows = [(HOUR, 10.0, 0.0, 0.0, 5.0), (HOUR + dt.timedelta(hours=1), 9.0, None, 0.0, 5.0)]
    return spark.createDataFrame(rows, FORECAST)


def test_score(spark, forecast):
    row = score.score(requests(spark, ("YU", HOUR.replace(minute=59), None)), forecast, FixedModel()).first()
    assert (row.line, row.at, row.p_delay_5min, row.status, row.snowfall) == ("YU", HOUR, 0.3, "ok", 0.0)


@pytest.mark.parametrize(
    "line, hours, text, status",
    [
        ("XX", 0, None, "bad_line"),
        (None, 0, None, "bad_line"),
        ("YU", 1, None, "no_weather"),
        ("YU", 500, "bad", "no_weather"),
        ("YU", 0, "bad", "bad_override"),
        ("YU", 0, "[1]", "bad_override"),
        ("YU", 0, '{"snowfall": "deep"}', "bad_override"),
        ("YU", 0, '{"snowfall": null}', "bad_override"),
        ("YU", 0, '{"snowfall": [1]}', "bad_override"),
        ("YU", 0, '{"humidity": "high"}', "ok"),
        ("YU", 0, "", "ok"),
        ("YU", 0, "{}", "ok"),
        ("YU", 0, ' {"snowfall": "4"}', "ok"),
    ],
)
def test_request_status(spark, forecast, line, hours, text, status):
    df = requests(spark, (line, HOUR + dt.timedelta(hours=hours), text))
    row = score.score(df, forecast, FixedModel()).first()
    assert row.status == status and (row.p_delay_5min is None) == (status != "ok")


def test_override(spark, forecast):
    row = score.score(requests(spark, ("BD", HOUR, '{"snowfall": 4}')), forecast, FixedModel()).first()
    assert (row.snowfall, row.temperature_2m) == (4.0, 10.0)


def test_weather_payload_and_coverage(spark):
    payload = spark.sql(
        "select named_struct('time', array('2026-01-01T00:00', '2026-01-01T01:00'), 'temperature_2m', array(1.5D, null), "
        "'precipitation', array(0D, 1D), 'snowfall', array(0D, 1D), 'wind_speed_10m', array(2D, 3D)) as hourly"
    )
    rows = weather.weather_rows(payload)
    assert [(r.hour.hour, r.temperature_2m) for r in rows.orderBy("hour").collect()] == [(0, 1.5), (1, None)]
    hours = spark.createDataFrame([(dt.datetime(2026, 1, 1, h),) for h in range(24)], "hour timestamp_ntz")
    assert weather.weather_coverage(rows, hours).first().covered
    assert weather.weather_gaps(rows, hours).count() == 22
    later = hours.union(spark.createDataFrame([(dt.datetime(2026, 1, 2, 5),)], "hour timestamp_ntz"))
    assert not weather.weather_coverage(rows, later).first().covered


def test_fit_save_load_predict(spark, tmp_path):
    rng, rows = random.Random(3), []
    for i in range(400):
        hour, line = i % 24, ["YU", "BD", "SHP"][i % 3]
        y = int(rng.random() < (0.9 if 7 <= hour <= 9 else 0.1))
        rows.append((line, hour, i % 7, 1 + i % 12, int(i % 7 >= 5), int(hour >= 6), 5.0, None if i % 5 == 0 else 1.0, 0.0, 2.0, y))
    frame = spark.createDataFrame(rows, ", ".join(["line string", *[f"{c} int" for c in FEATURES[1:6]], *[f"{c} double" for c in FEATURES[6:]], "any_delay_5min int"]))
    fitted = model.fit(frame, maxIter=5, maxDepth=3)
    sinks.save_model(fitted, str(tmp_path / "m"))
    loaded = sinks.load_model(str(tmp_path / "m"))
    scored = model.predict(loaded, frame)
    assert scored.columns == [*frame.columns, "p"]
    assert metrics.evaluate(scored).first().roc_auc > 0.8
    unseen = model.predict(loaded, frame.withColumn("line", F.lit("XX")))
    assert unseen.filter("p between 0 and 1").count() == 400


def test_held_out_quality(spark):
    """On days it has not seen, the model ranks nearly as well as the rates the days were drawn from, better than the
    baseline, which knows no weather, and it is calibrated."""
    rng, rows, start = random.Random(17), [], dt.datetime(2026, 1, 1)
    for day in range(120):
        cold = rng.uniform(-15, 20)
        for h in range(24):
            at = start + dt.timedelta(days=day, hours=h)
            for line, base in (("YU", 0.35), ("BD", 0.2), ("SHP", 0.05)):
                rate = min(0.95, base * (2 if h in (7, 8, 9, 16, 17, 18) else 0.7) * (0.6 if at.weekday() >= 5 else 1) * (1.8 if cold < -5 else 0.9))
                rows.append((at, line, cold, None if day % 10 == 0 else 0.0, 0.0, 5.0, rate, int(rng.random() < rate)))
    raw = spark.createDataFrame(
        rows, "hour timestamp_ntz, line string, temperature_2m double, precipitation double, snowfall double, wind_speed_10m double, rate double, delays_5min int"
    )
    train, test = features.time_split(features.add_features(raw).cache(), 30)
    scored = model.predict(model.fit(train, maxIter=40), test)
    frames = {"model": scored, "baseline": features.baseline_rate(train, test), "truth": test.withColumn("p", F.col("rate"))}
    got = {r.model: r for r in metrics.evaluate_each(frames).collect()}
    assert got["truth"].roc_auc - 0.03 < got["model"].roc_auc < got["truth"].roc_auc + 0.03
    assert got["model"].roc_auc > got["baseline"].roc_auc > 0.6 and got["model"].brier < got["baseline"].brier
    mean = scored.agg(F.avg("p").alias("p"), F.avg("any_delay_5min").alias("y")).first()
    assert mean.p == pytest.approx(mean.y, abs=0.05)


def test_early_stopping(spark):
    rng = random.Random(5)
    rows = [(["YU", "BD"][i % 2], i % 24, i % 7, 1, 0, 1, rng.random(), 0.0, 0.0, 0.0, int(rng.random() < 0.5)) for i in range(600)]
    frame = spark.createDataFrame(rows, ", ".join(["line string", *[f"{c} int" for c in FEATURES[1:6]], *[f"{c} double" for c in FEATURES[6:]], "any_delay_5min int"]))
    stopped, full = model.fit(frame, early_stopping=True, maxIter=12), model.fit(frame, maxIter=12)
    assert stopped.stages[-1].getNumTrees < full.stages[-1].getNumTrees == 12


def test_rows_of_one_file_are_fitted_in_several_tasks(spark):
    """A frame is often one file; its rows are dealt evenly over the cores that they are worth."""
    frame = spark.range(0, 3 * model.LEAST_PER_TASK, 1, 1)
    spread = model._spread(frame)
    sizes = spread.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == frame.count() and len(sizes) == 3 and max(sizes) < 1.1 * model.LEAST_PER_TASK
    assert model._spread(spark.range(0, 1000, 1, 6)).rdd.getNumPartitions() == 1
    cores = spark.sparkContext.defaultParallelism
    assert model._spread(spark.range(0, 2 * cores * model.LEAST_PER_TASK, 1, 40)).rdd.getNumPartitions() == cores


def test_published_settings():
    assert model.GBT == {"maxIter": 300, "stepSize": 0.05, "maxDepth": 5, "seed": 0}


def test_pr_auc_of_very_many_rows(spark):
    curve = spark.createDataFrame(
        [(0.9, 4_000_000_000, 1_000_000_000, 0, 0), (0.1, 1_000_000_000, 4_000_000_000, 4_000_000_000, 1_000_000_000)],
        "score double, pos long, neg long, pos_above long, neg_above long",
    )
    got = curve.agg(metrics._pr_auc().alias("ap"), metrics._roc_auc().alias("auc")).first()
    assert got.ap == pytest.approx(0.8 * 0.8 + 0.2 * 0.5) and got.auc == pytest.approx(0.8)


def test_newest_batch_with_a_missing_load_time(spark):
    from wardbook.operators.snapshots import latest_by_key

    rows = [("a", 1, None), ("b", 2, None), ("b", 3, "2026-01-02"), (None, 4, None)]
    df = spark.createDataFrame(rows, "k string, v int, at string").selectExpr("k", "v", "timestamp(at) AS _loaded_at")
    assert sorted(r.v for r in latest_by_key(df, "k").collect()) == [1, 3, 4]
