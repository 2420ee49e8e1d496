"""The given tables seen as panels: which columns play zone, time, price and covariates.

Values of ``events``, ``orders`` and ``lineitem`` carry two decimals. They are summed as whole
hundredths, so that a panel is the same bit for bit however the rows were partitioned or a task
was retried. (A long sum of rint is also several times faster than a decimal one.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.clock import (
    hour_floor,
    local_date,
    minutes_floor,
    plus_minutes,
)
from zonecast.operators.marts import hourly_fact, interval_fact, weather_fact
from zonecast.session import materialise
from zonecast.sources.generators import calendar, days_between
from zonecast.sources.tables import driver_table

PRICE_SHIFT = 20.0
ORDER_SCALE = 100000.0
EUR_RATE = 11.2
EVENT_NEIGHBOURS = {
    "click": "prev_click_mean",
    "purchase": "prev_purchase_mean",
    "view": "prev_view_mean",
}
EVENT_NORTH = ("click", "error")


def exact_mean(value: str) -> Column:
    return F.sum(F.rint(F.col(value) * 100).cast("bigint")).cast("double") / 100.0 / F.count("*")


def market_intervals(spark: SparkSession, sf_dir: str, minutes: int = 15) -> DataFrame:
    """``events`` as market intervals: zone = event type, price = mean value less a shift."""
    price = exact_mean("value") - PRICE_SHIFT
    return (
        driver_table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("zone"), minutes_floor("ts", minutes).alias("interval_start"))
        .agg(price.alias("price_sek_kwh"))
        .select(
            "zone",
            local_date("interval_start").alias("delivery_date"),
            "interval_start",
            plus_minutes("interval_start", minutes).alias("interval_end"),
            F.lit(minutes).alias("resolution_minutes"),
            "price_sek_kwh",
            (F.col("price_sek_kwh") / EUR_RATE).alias("price_eur_kwh"),
            F.lit(EUR_RATE).alias("eur_sek_rate"),
        )
    )


def intervals(spark: SparkSession, sf_dir: str, minutes: int = 15) -> DataFrame:
    return interval_fact(market_intervals(spark, sf_dir, minutes))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_fact(intervals(spark, sf_dir))


def stored_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interval fact as a stored table, for queries that read it more than once."""
    return materialise(intervals(spark, sf_dir), "intervals")


def stored_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(hourly(spark, sf_dir), "hourly")


def stored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(daily_panel(spark, sf_dir), "order-days")


def zones_of(panel: DataFrame) -> DataFrame:
    return panel.select("zone").distinct()


def calendar_of(panel: DataFrame) -> DataFrame:
    """Calendar from the first day of a panel to a week after the last."""
    bounds = panel.agg(
        F.min("delivery_date").alias("first"), F.max("delivery_date").alias("last")
    )
    return calendar(days_between(bounds, "first", "last", extra_days=7))


def _event_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covariates of ``events`` (JSON property and user), two points per zone and hour."""
    k = F.get_json_object("props", "$.k").cast("int")
    return (
        driver_table(spark, sf_dir, "events")
        .select(
            F.col("event_type").alias("zone"),
            F.concat_ws("-", "event_type", F.when(F.col("user_id") < 75, "low").otherwise("high")).alias(
                "point"
            ),
            hour_floor("ts").alias("hour"),
            k.alias("k"),
            "user_id",
        )
        .groupBy("point", "zone", "hour")
        .agg(
            (F.avg("k") - 40.0).alias("temperature_2m"),
            (F.avg("k") / 5.0).alias("wind_speed_100m"),
            F.avg("user_id").alias("shortwave_radiation"),
            F.max("k").cast("double").alias("cloud_cover"),
        )
    )


WEATHER = ("temperature_2m", "wind_speed_100m", "shortwave_radiation", "cloud_cover")


def weather_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_weather(spark, sf_dir).select(
        "point", "zone", F.col("hour").alias("valid_at"), *WEATHER
    )


def as_snapshots(points: DataFrame) -> DataFrame:
    """Each local day's covariates read as the forecast issued that day for the next one."""
    return points.select(
        local_date("valid_at").alias("issue_date"),
        "point",
        "zone",
        F.timestamp_add("DAY", F.lit(1), F.col("valid_at")).alias("valid_at"),
        *WEATHER,
    )


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_fact(weather_points(spark, sf_dir))


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a panel with one slot per day: zone = priority, price = mean order value."""
    return (
        driver_table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("zone"), F.col("o_orderdate").cast("date").alias("delivery_date"))
        .agg((exact_mean("o_totalprice") / ORDER_SCALE).alias("price_sek_kwh"))
        .select(
            "zone",
            "delivery_date",
            F.col("delivery_date").cast("timestamp_ntz").alias("hour_start"),
            F.lit(0).alias("hour_local"),
            "price_sek_kwh",
        )
    )
