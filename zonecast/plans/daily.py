"""The daily issue: forecast the first unpublished day once, and never rewrite it."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.operators.calibrate import apply_margin
from zonecast.operators.features import labelled, live
from zonecast.operators.models import QuantileForest, naive_day
from zonecast.sources.sinks import is_logged, write_once

MODEL_VERSION = "quantile-forest-cqr-v1"


def forecast_live(
    features: DataFrame,
    margins: DataFrame,
    zone_codes: dict[str, int],
    forest: QuantileForest = QuantileForest(),
    inputs: list[str] | None = None,
    issued_at: datetime | None = None,
) -> DataFrame:
    """Calibrated forecast of the earliest unlabelled day.

    ``margins`` holds (zone, interval_margin); zones without one get no correction.
    """
    known, pending = labelled(features), live(features)
    naive = naive_day()[1].alias("naive_day")
    keep = ("zone", "delivery_date", "hour_start", "hour_local")
    fitted = forest.fit(known, zone_codes, inputs)
    predicted = fitted.transform(pending, *keep)
    facts = pending.select("zone", "hour_start", "weather_source", naive)
    at = (issued_at or datetime.now(UTC)).replace(tzinfo=None)
    trained = known.agg(F.max("delivery_date")).scalar()
    return (
        predicted.join(facts, ["zone", "hour_start"])
        .join(margins.select("zone", "interval_margin"), "zone", "left")
        .withColumn("interval_margin", F.coalesce("interval_margin", F.lit(0.0)))
        .withColumns(apply_margin(F.col("interval_margin")))
        .select(
            *keep[:3],
            F.col("hour_local").cast("int"),
            "weather_source",
            "q10",
            "q50",
            "q90",
            "interval_margin",
            "naive_day",
            F.lit(at.isoformat(" ")).cast("timestamp_ntz").alias("issued_at"),
            F.lit(MODEL_VERSION).alias("model_version"),
            trained.alias("trained_through"),
        )
    )


def issue(
    features: DataFrame,
    path: str,
    margins: DataFrame,
    zone_codes: dict[str, int],
    forest: QuantileForest = QuantileForest(),
    inputs: list[str] | None = None,
    issued_at: datetime | None = None,
) -> bool:
    """Write the live forecast to the issued log; False if there is nothing new to issue.

    The log is looked up before the model is trained, and once more by the write itself.
    """
    target = live(features).agg(F.max("delivery_date").alias("d")).first()["d"]
    if target is None:
        return False
    if is_logged(features.sparkSession, path, delivery_date=target):
        return False
    forecast = forecast_live(features, margins, zone_codes, forest, inputs, issued_at)
    write_once(forecast, path, "delivery_date")
    return True
