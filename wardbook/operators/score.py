"""Batch scoring of delay-risk requests."""

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.operators.features import add_features
from wardbook.operators.model import predict
from wardbook.schema import LINES, WEATHER_VARS
from wardbook.sources.weather import forecast_at


def override_values(parsed: Column) -> tuple[dict[str, Column], Column]:
    """The known keys of a parsed JSON object as doubles (null when absent), and whether all those
    present are numbers. Unknown keys are ignored."""
    numeric = F.lit(True)
    values = {}
    for name in WEATHER_VARS:
        values[name] = F.try_variant_get(parsed, f"$.{name}", "double")
        absent = F.try_variant_get(parsed, f"$.{name}", "variant").isNull()
        numeric = numeric & (absent | values[name].isNotNull())
    return values, numeric


def apply_override(df: DataFrame, column: str = "weather") -> DataFrame:
    """Replace each weather variable by its override; adds ``override_ok``. No text is a valid, empty
    override. The text is parsed once per row, in its own projection."""
    text = F.coalesce(F.col(column), F.lit(""))
    values, numeric = override_values(F.col("_override"))
    is_object = F.col("_override").isNotNull() & F.btrim(text, F.lit(" \t\r\n")).startswith("{")
    return (
        df.withColumn("_override", F.when(text != "", F.try_parse_json(text)))
        .withColumns(
            {n: F.coalesce(v, F.col(n)) for n, v in values.items()}
            | {"override_ok": (text == "") | (is_object & numeric)}
        )
        .drop("_override")
    )


def prepare_requests(requests: DataFrame, forecast: DataFrame) -> DataFrame:
    """Requests (line, at, weather) with hour, weather and ``status``; nothing is guessed.

    The first fault found is reported: an unknown line, no forecast for the hour, a bad override.
    """
    status = (
        F.when(F.coalesce(~F.col("line").isin(LINES), F.lit(True)), "bad_line")
        .when(~F.col("has_forecast"), "no_weather")
        .when(~F.col("override_ok"), "bad_override")
        .otherwise("ok")
    )
    return (
        apply_override(forecast_at(requests, forecast))
        .withColumn("status", status)
        .drop("has_forecast", "override_ok", "weather")
    )


def score(requests: DataFrame, forecast: DataFrame, model: PipelineModel) -> DataFrame:
    """One row per request: its line, hour, probability (3 decimals), weather used and status."""
    prepared = prepare_requests(requests, forecast)
    features = add_features(prepared.withColumns({"hour": F.col("at"), "delays_5min": F.lit(0)}))
    scored = predict(model, features)
    p = F.when(F.col("status") == "ok", F.round("p", 3))
    return scored.select(*[c for c in requests.columns if c != "weather"], p.alias("p_delay_5min"), *WEATHER_VARS, "status")
