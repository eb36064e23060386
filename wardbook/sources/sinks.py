"""Metrics and model files."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One JSON line; the frame holds one row, so one file costs nothing."""
    metrics.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
