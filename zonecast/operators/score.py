"""Forecast metrics by group, the issued-forecast track record and its log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import AUCTION_CLOSE_HOUR, MARKET_TZ, QCOLS, QUANTILES
from zonecast.functions.clock import to_local
from zonecast.functions.numeric import inside, pinball

BASELINE = "naive_day"


def metric_columns() -> list[Column]:
    """n, MAE, RMSE, bias, mean pinball loss and inclusive 80 % coverage of a group."""
    y, error = F.col("target_price"), F.col("q50") - F.col("target_price")
    losses = [pinball(y, F.col(c), q) for c, q in zip(QCOLS, QUANTILES, strict=True)]
    # A forecast that couldn't be made is no miss; a bound that is missing beside a median is one.
    made = F.col("q50").isNotNull()
    hit = F.when(made, F.coalesce(inside(y, F.col("q10"), F.col("q90")), F.lit(0.0)))
    return [
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error).alias("bias"),
        (sum((F.avg(x) for x in losses[1:]), F.avg(losses[0])) / len(losses)).alias("pinball"),
        F.avg(hit).alias("coverage_80"),
    ]


def score(
    predictions: DataFrame, raw_models: tuple[str, ...] = (), baseline: str = BASELINE
) -> DataFrame:
    """Metrics overall, by zone and by year for every model: (scope, part, model, ...).

    Grouping sets give all three views in one pass. The skill compares with the baseline's MAE in
    the same view and part; a window over the few models of a part finds it without a self-join.
    """
    y = F.col("target_price")
    metrics = metric_columns()
    if raw_models:
        raw = inside(y, F.col("q10_raw"), F.col("q90_raw"))
        hit = F.when(F.col("q50").isNotNull(), F.coalesce(raw, F.lit(0.0)))
        metrics.append(F.avg(hit).alias("raw_coverage"))
    keyed = predictions.withColumn("year", F.year("delivery_date"))
    grouped = keyed.groupingSets(
        [["model"], ["zone", "model"], ["year", "model"]], "model", "zone", "year"
    ).agg(*metrics, F.grouping("zone").alias("no_zone"), F.grouping("year").alias("no_year"))
    scope = (
        F.when(F.col("no_zone") == 0, F.lit("zone"))
        .when(F.col("no_year") == 0, F.lit("year"))
        .otherwise(F.lit("overall"))
    )
    part = (
        F.when(F.col("no_zone") == 0, F.col("zone"))
        .when(F.col("no_year") == 0, F.col("year").cast("string"))
        .otherwise(F.lit("all"))
    )
    base = F.max(F.when(F.col("model") == baseline, F.col("mae"))).over(
        Window.partitionBy("scope", "part")
    )
    out = grouped.withColumns({"scope": scope, "part": part}).withColumn(
        "skill_vs_naive_day", 1 - F.col("mae") / F.nullif(base, F.lit(0.0))
    )
    uncalibrated = []
    if raw_models:
        shown = (F.col("scope") == "overall") & F.col("model").isin(*raw_models)
        uncalibrated = [F.when(shown, F.col("raw_coverage")).alias("coverage_80_uncalibrated")]
    return out.select(
        "scope", "part", "model", "n", "mae", "rmse", "bias", "pinball", "coverage_80",
        "skill_vs_naive_day", *uncalibrated,
    )


def monthly_errors(predictions: DataFrame, models: tuple[str, ...]) -> DataFrame:
    """Mean absolute error per month, one column per model."""
    return (
        predictions.withColumn("abs_err", F.abs(F.col("q50") - F.col("target_price")))
        .groupBy(F.date_format("fold", "yyyy-MM").alias("month"))
        .pivot("model", list(models))
        .agg(F.avg("abs_err"))
    )


def evaluation_period(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.min("delivery_date").alias("first_day"),
        F.max("delivery_date").alias("last_day"),
        F.count_distinct("delivery_date").alias("days"),
    )


def with_actuals(issued: DataFrame, hourly: DataFrame) -> DataFrame:
    """Issued forecasts joined to the prices that cleared; hours still open drop out."""
    actual = hourly.select("zone", "hour_start", F.col("price_sek_kwh").alias("actual"))
    return issued.join(actual, ["zone", "hour_start"])


def track_record_days(scored: DataFrame) -> DataFrame:
    """Per day and zone: error of the forecast and of the baseline, and the hit share.

    ``hours`` counts the priced hours, and the other counts those that have the figure; an hour without one is left out of that figure alone.
    """
    actual = F.col("actual")
    figures = {
        "mae_model": F.abs(F.col("q50") - actual),
        "mae_naive": F.abs(F.col("naive_day") - actual),
        "coverage": inside(actual, F.col("q10"), F.col("q90")),
    }
    return scored.groupBy("delivery_date", "zone").agg(
        *[F.avg(x).alias(name) for name, x in figures.items()],
        F.count("*").alias("hours"),
        *[F.count(x).alias(f"{name}_hours") for name, x in figures.items()],
    )


def day_means(days: DataFrame) -> DataFrame:
    """Mean over zones per day."""
    return days.groupBy("delivery_date").agg(
        F.avg("mae_model").alias("mae_model"),
        F.avg("mae_naive").alias("mae_naive"),
        F.avg("coverage").alias("coverage"),
        F.sum("hours").alias("hours"),
    )


def track_record_summary(scored: DataFrame) -> DataFrame:
    """One row: days scored, row-weighted errors and coverage, and days better than the baseline.

    Row-weighted figures come from the (day, zone) sums, so the joined rows are read once.
    """
    figures = ("mae_model", "mae_naive", "coverage")
    by_day = track_record_days(scored).groupBy("delivery_date").agg(
        (F.avg("mae_model") < F.avg("mae_naive")).cast("int").alias("better"),
        *[F.sum(F.col(f) * F.col(f"{f}_hours")).alias(f) for f in figures],
        *[F.sum(f"{f}_hours").alias(f"{f}_hours") for f in figures],
    )
    per_hour = lambda f: F.try_divide(F.sum(f), F.sum(f"{f}_hours"))
    return by_day.agg(
        F.count("*").alias("days"),
        per_hour("mae_model").alias("mae_model"),
        per_hour("mae_naive").alias("mae_naive"),
        F.sum("better").alias("days_beating_naive"),
        per_hour("coverage").alias("coverage_80"),
    )


def issue_timing(tz: str = MARKET_TZ, close_hour: int = AUCTION_CLOSE_HOUR) -> Column:
    """'before' when issued before the auction closes at noon on the day before delivery."""
    local = to_local("issued_at", tz)
    day_before = F.date_sub("delivery_date", 1)
    before = (local.cast("date") < day_before) | (
        (local.cast("date") == day_before) & (F.hour(local) < close_hour)
    )
    return F.when(before, F.lit("before")).otherwise(F.lit("after"))


def issue_log(issued: DataFrame, scored: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """One row per issued day, newest first: when, by which version, and its scores once prices are there.

    ``position`` counts from the newest day; there is one row a day, so numbering them is bounded by the calendar.
    """
    place = F.row_number().over(Window.orderBy(F.desc("delivery_date"))).cast("bigint")
    first = F.min(F.struct("zone", "hour_start", "issued_at", "model_version"))
    days = issued.groupBy("delivery_date").agg(first.alias("first")).select(
        "delivery_date", "first.issued_at", "first.model_version"
    )
    means = day_means(track_record_days(scored))
    return days.join(means, "delivery_date", "left").select(
        place.alias("position"),
        "delivery_date",
        "issued_at",
        "model_version",
        issue_timing(tz).alias("timing"),
        F.when(F.col("hours").isNull(), F.lit("waiting")).otherwise(F.lit("scored")).alias("status"),
        "mae_model",
        "mae_naive",
        "coverage",
    )
