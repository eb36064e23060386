"""Ranking and calibration metrics of scored rows: ROC-AUC, average precision, Brier score."""

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardbook.schema import FEATURES, TARGET
from wardbook.session import ensure_checkpoint_dir

# Distinct scores that one task sorts.
_SCORES_PER_BUCKET = 65_536


def score_curve(
    scored: DataFrame, score: str = "p", label: str = TARGET, per_bucket: int = _SCORES_PER_BUCKET, by: str | None = None
) -> DataFrame:
    """One row per distinct score with its positives and negatives, and the positives and negatives
    scored higher; with ``by``, all that for each value of this column.

    The running totals are exact without a global sort: scores fall into quantile buckets, as many as their
    number asks for, the bucket totals are summed in one small window, and each bucket is summed on its own. The counts per score
    are checkpointed, since they are read three times and scoring is dear.
    """
    ensure_checkpoint_dir(scored.sparkSession)
    positives, keys = F.sum(F.col(label).cast("long")), [by] if by else []
    per_score = scored.groupBy(*keys, F.col(score).cast("double").alias("score")).agg(
        positives.alias("pos"), (F.count(label) - positives).alias("neg")
    )
    per_score = per_score.checkpoint()
    buckets = max(1, -(-per_score.count() // per_bucket))
    bucketed = per_score.withColumn("bucket", F.lit(0.0))
    if buckets > 1:
        quantiles = per_score.approxQuantile("score", [i / buckets for i in range(1, buckets)], 0.5 / buckets)
        splits = [float("-inf"), *sorted(set(quantiles)), float("inf")]
        bucketed = Bucketizer(splits=splits, inputCol="score", outputCol="bucket").transform(per_score)

    higher = W.partitionBy(*keys).orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy(*keys, "bucket")
        .agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
        .select(*keys, "bucket", *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(c) for c in ("_pos", "_neg")])
    )
    within = W.partitionBy(*keys, "bucket").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)
    return bucketed.join(starts, [*keys, "bucket"]).select(
        *keys,
        "score",
        "pos",
        "neg",
        *[
            (F.col(f"_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(f"{c}_above")
            for c in ("pos", "neg")
        ],
    )


def _roc_auc():
    pairs = F.col("neg").cast("decimal(20,0)") * (2 * F.col("pos_above") + F.col("pos"))
    total = F.sum("pos").cast("double") * F.sum("neg")
    return F.sum(pairs).cast("double") / F.nullif(2 * total, F.lit(0.0))


def _pr_auc():
    hits = F.col("pos_above") + F.col("pos")
    seen = hits + F.col("neg_above") + F.col("neg")
    # As doubles: positives times hits outgrow a long.
    return F.sum(F.col("pos").cast("double") * hits / seen) / F.nullif(F.sum("pos"), F.lit(0))


def _brier():
    score = F.col("score")
    return F.sum(F.col("pos") * F.pow(1 - score, 2) + F.col("neg") * F.pow(score, 2)) / F.sum(F.col("pos") + F.col("neg"))


_METRICS = {"roc_auc": _roc_auc, "pr_auc": _pr_auc, "brier": _brier}


def evaluate(scored: DataFrame, names: list[str] | None = None, **curve_args) -> DataFrame:
    """One row with the metrics, all from one curve."""
    return score_curve(scored, **curve_args).agg(*[_METRICS[n]().alias(n) for n in names or _METRICS])


def evaluate_each(scored_by_name: dict[str, DataFrame], label: str = TARGET, score: str = "p", **curve_args) -> DataFrame:
    """One row per scored frame, ``model`` and its metrics, all from one curve over all frames. A frame without
    rows has no row."""
    frames = [
        df.select(F.lit(name).alias("model"), F.col(score).cast("double").alias("p"), F.col(label).alias("label"))
        for name, df in scored_by_name.items()
    ]
    curve = score_curve(reduce(DataFrame.unionByName, frames), label="label", by="model", **curve_args)
    return curve.groupBy("model").agg(*[metric().alias(n) for n, metric in _METRICS.items()])


def roc_auc(scored: DataFrame, **curve_args) -> DataFrame:
    return evaluate(scored, ["roc_auc"], **curve_args)


def pr_auc(scored: DataFrame, **curve_args) -> DataFrame:
    """Average precision: precision at each distinct score, weighted by the positives it adds."""
    return evaluate(scored, ["pr_auc"], **curve_args)


def brier(scored: DataFrame, score: str = "p", label: str = TARGET) -> DataFrame:
    return scored.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def metrics_row(
    train: DataFrame, test: DataFrame, split: DataFrame, scored_by_name: dict[str, DataFrame], trained_at: str
) -> DataFrame:
    """The metrics record: one row, one struct per scored frame, rounded to 4 decimals.

    Every part is itself one row, joined on a constant; all scored frames share one curve.
    """
    rows = train.select(F.lit(0).alias("is_test"), TARGET).unionByName(test.select(F.lit(1).alias("is_test"), TARGET))
    record = rows.agg(
        F.lit(trained_at).alias("trained_at"),
        F.count_if(F.col("is_test") == 0).alias("rows_train"),
        F.count_if(F.col("is_test") == 1).alias("rows_test"),
        F.round(F.avg(TARGET), 4).alias("positive_rate"),
    ).withColumn("test_from", F.to_char(split.select(F.col("split_at").cast("date")).scalar(), F.lit("yyyy-MM-dd")))
    if scored_by_name:
        # One row per frame.
        found = evaluate_each(scored_by_name).withColumn("found", F.struct(*[F.round(m, 4).alias(m) for m in _METRICS]))
        none = F.struct(*[F.lit(None).cast("double").alias(m) for m in _METRICS])
        by_name = [F.coalesce(F.first(F.when(F.col("model") == n, F.col("found")), True), none).alias(n) for n in scored_by_name]
        record = record.withColumn("_found", found.agg(F.struct(*by_name).alias("found")).scalar())
        record = record.select("*", "_found.*").drop("_found")
    return record.withColumn("features", F.array(*map(F.lit, FEATURES)))
