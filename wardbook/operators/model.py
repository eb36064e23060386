"""The delay-risk classifier: boosted trees on time, line and weather."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.schema import FEATURES, HISTORY_FEATURES, TARGET
from wardbook.session import ensure_checkpoint_dir

# The boosting settings that Spark's trees can share with the published model. Its 31
# leaves become depth 5; Spark has no L2 penalty.
GBT = {"maxIter": 300, "stepSize": 0.05, "maxDepth": 5, "seed": 0}
# Trees between two checkpoints of the residuals: boosting is thousands of jobs, whose cost on small frames is that of
# their tasks and files, and of the lineage that each job carries.
CHECKPOINT_INTERVAL = 20
# Rows that are worth a task while there are cores left, and beyond these.
LEAST_PER_TASK, ROWS_PER_TASK = 1 << 14, 1 << 17
# With early stopping, one row in so many is set aside and boosting stops when its loss rises.
VALIDATION_SHARE = 10
# Below every real reading, so that a split can send missing readings their own way.
_MISSING = -1.0e6


def delay_model(features: list[str] = FEATURES, **gbt) -> Pipeline:
    """An unfitted model over ``features``; an unseen line gets no indicator, as one never trained on."""
    numeric = [f for f in features if f != "line"]
    filled = ", ".join(f"coalesce(cast({f} as double), {_MISSING}D) AS x_{f}" for f in numeric)
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
            StringIndexer(inputCol="line", outputCol="x_line_index", handleInvalid="keep"),
            OneHotEncoder(inputCol="x_line_index", outputCol="x_line", dropLast=True),
            VectorAssembler(inputCols=["x_line", *[f"x_{f}" for f in numeric]], outputCol="x_features"),
            GBTClassifier(featuresCol="x_features", labelCol=TARGET, **{**GBT, "checkpointInterval": CHECKPOINT_INTERVAL, **gbt}),
        ]
    )


def fit(train: DataFrame, features: list[str] = FEATURES, early_stopping: bool = False, **gbt) -> PipelineModel:
    """Fit on the columns the model needs. The checkpoint folder lets boosting cut its growing lineage.

    All rows are fitted, with all trees, unless ``early_stopping`` is asked for. Rows are then set aside by a
    hash of their features, so that a recomputed partition sets the same rows aside.
    """
    ensure_checkpoint_dir(train.sparkSession)
    rows = train.select(*features, TARGET)
    if early_stopping:
        aside = F.pmod(F.xxhash64(*features), F.lit(VALIDATION_SHARE)) == 0
        rows = rows.withColumn("x_validation", aside)
        gbt = {"validationIndicatorCol": "x_validation", "validationTol": 0.0, **gbt}
    return delay_model(features, **gbt).fit(_spread(rows))


def _spread(rows: DataFrame) -> DataFrame:
    """``rows`` in as many equal parts as are worth their tasks. A frame is often one file, and so one task, which
    every level of every tree would wait for."""
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(-(-n // LEAST_PER_TASK), max(cores, -(-n // ROWS_PER_TASK))))
    return rows.coalesce(1) if tasks == 1 else rows.repartition(tasks)


def fit_each(runs: list[tuple[DataFrame, list[str]]], **gbt) -> list[PipelineModel]:
    """Fit several models side by side: boosting is many short jobs, which leave room for each other."""
    with ThreadPoolExecutor(len(runs)) as pool:
        return list(pool.map(lambda run: fit(*run, **gbt), runs))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    scored = model.transform(df).withColumn("p", vector_to_array("probability")[1])
    return scored.select(*df.columns, "p")


def informed_features() -> list[str]:
    """The reported experiment: the served features and the line's recent delays."""
    return [*FEATURES, *HISTORY_FEATURES]


def mean_score(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("n_rows"), F.avg("p").alias("mean_p"))
