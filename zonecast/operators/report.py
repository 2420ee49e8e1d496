"""Report datasets: one tidy DataFrame per block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import MARKET_TZ
from zonecast.functions.clock import hour_floor, to_local
from zonecast.functions.selection import floor_rank_values

# Fixed values of the report.
RECENT_DAYS = 120
PRICE_BINS = 7
CHEAPEST = 3


def newest(df: DataFrame, column: str = "delivery_date") -> DataFrame:
    """Rows of the newest value of ``column``."""
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def tomorrow(issued: DataFrame) -> DataFrame:
    """The newest issued forecast, hour by hour for each zone."""
    return newest(issued).select(
        "delivery_date", "issued_at", "model_version", "zone", "hour_local", "hour_start",
        "q10", "q50", "q90", F.col("naive_day").alias("naive"),
    )


def tomorrow_by_zone(issued: DataFrame) -> DataFrame:
    """The same with one row per zone holding its (at most 25) hours in order."""
    hour = F.struct("hour_start", F.col("hour_local").alias("hour"), "q10", "q50", "q90", "naive")
    return tomorrow(issued).groupBy("delivery_date", "zone").agg(
        F.min("issued_at").alias("issued_at"),
        F.min("model_version").alias("model_version"),
        F.array_sort(F.collect_list(hour)).alias("hours"),
    )


def latest_actual(intervals: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """The newest priced day at market resolution, in local time."""
    return newest(intervals).select(
        "delivery_date",
        "zone",
        "resolution_minutes",
        "interval_start",
        to_local("interval_start", tz).alias("start_local"),
        F.col("price_sek_kwh").alias("price"),
    )


def recent_days(stats: DataFrame, days: int = RECENT_DAYS) -> DataFrame:
    """Daily statistics of the last ``days`` calendar days."""
    last = stats.agg(F.max("delivery_date")).scalar()
    return stats.where(F.col("delivery_date") > F.date_sub(last, days)).select(
        "delivery_date", "zone", "mean_price", "min_price", "max_price", "intraday_spread",
        "negative_intervals",
    )


def pipeline_health(intervals: DataFrame, quarantined: DataFrame, tests: DataFrame) -> DataFrame:
    """One row: coverage of the interval fact, quarantined days and data tests."""
    counts = intervals.agg(
        F.count_distinct("delivery_date").alias("days"),
        F.count("*").alias("intervals"),
        F.min("delivery_date").alias("first_day"),
        F.max("delivery_date").alias("last_day"),
        F.count_distinct("zone").alias("zones"),
    )
    # The suite is planned once: both of its numbers come from one row.
    passed = tests.agg(F.count_if(F.col("failures") == 0).alias("tests_passed"), F.count("*").alias("tests_total"))
    both = passed.select(F.struct("tests_passed", "tests_total")).scalar()
    held = quarantined.agg(F.count("*")).scalar()
    return counts.select("*", held.alias("quarantined_days"), both.alias("tests")).select(
        *counts.columns, "quarantined_days", "tests.tests_passed", "tests.tests_total"
    )


def zone_cards(issued: DataFrame, intervals: DataFrame) -> DataFrame:
    """Per zone: mean of the newest forecast and mean of the newest priced day."""
    forecast = newest(issued).groupBy("zone").agg(F.avg("q50").alias("forecast_mean"))
    actual = newest(intervals).groupBy("zone").agg(F.avg("price_sek_kwh").alias("actual_mean"))
    return forecast.join(actual, "zone", "full_outer")


def occurrence_label() -> Column:
    """Local hour as text, with a b on the second pass of the autumn day's repeated hour."""
    nth = F.row_number().over(
        Window.partitionBy("zone", "delivery_date", "hour_local").orderBy("hour_start")
    )
    return F.concat(
        F.lpad(F.col("hour_local").cast("string"), 2, "0"),
        F.when(nth > 1, F.lit("b")).otherwise(F.lit("")),
    )


def cheapest_hours(hours: DataFrame, price: str, k: int = CHEAPEST) -> DataFrame:
    """The k cheapest hours of every zone and day; of equals the earlier."""
    place = F.row_number().over(
        Window.partitionBy("zone", "delivery_date").orderBy(
            F.col(price).asc_nulls_last(), "hour_start"
        )
    )
    return hours.withColumn("place", place).where(F.col("place") <= k)


def price_cuts(hours: DataFrame, price: str = "q50", bins: int = PRICE_BINS) -> DataFrame:
    """(position, cut): the bins - 1 cut points between equally filled price bins."""
    return floor_rank_values(hours, price, [i / bins for i in range(1, bins)])


def timetable(issued: DataFrame, bins: int = PRICE_BINS, k: int = CHEAPEST) -> DataFrame:
    """The newest forecast with column labels, price bins and the cheapest hours marked."""
    day = newest(issued)
    cuts = price_cuts(day, "q50", bins).agg(F.collect_list("cut")).scalar()
    place = F.row_number().over(
        Window.partitionBy("zone", "delivery_date").orderBy(
            F.col("q50").asc_nulls_last(), "hour_start"
        )
    )
    return day.withColumn("cuts", cuts).select(
        "zone",
        "delivery_date",
        "hour_start",
        occurrence_label().alias("label"),
        "q50",
        F.size(F.filter("cuts", lambda c: F.col("q50") >= c)).alias("bin"),
        ((place <= k) & F.col("q50").isNotNull()).alias("cheap"),
    )


def aligned_actual(issued: DataFrame, intervals: DataFrame) -> DataFrame:
    """Hours of the newest forecast next to the newest priced day at the same clock time."""
    target = newest(issued)
    actual = newest(intervals)
    ahead = F.date_diff(
        target.agg(F.max("delivery_date")).scalar(), actual.agg(F.max("delivery_date")).scalar()
    )
    shifted = actual.select(
        "zone",
        "price_sek_kwh",
        hour_floor(F.timestamp_add("DAY", ahead, F.col("interval_start"))).alias("hour_start"),
    )
    means = shifted.groupBy("zone", "hour_start").agg(F.avg("price_sek_kwh").alias("day_before"))
    return target.join(means, ["zone", "hour_start"], "left").select(
        "zone", "hour_start", "hour_local", "q10", "q50", "q90", "day_before"
    )


def share_of_largest(rows: DataFrame, value: str, *within: str) -> DataFrame:
    """Each value as a share of the largest absolute one, for rows already aggregated."""
    largest = F.max(F.abs(value)).over(Window.partitionBy(*within))
    return rows.withColumn("share", F.abs(value) / F.nullif(largest, F.lit(0.0)))
