"""Star schema: interval and hourly facts, the weather fact and the daily mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.config import MARKET_TZ
from zonecast.functions.clock import hour_floor, local_hour, to_local


def interval_fact(prices: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """One row per zone and market interval, with its local start."""
    return prices.select(
        "zone",
        "delivery_date",
        "interval_start",
        "interval_end",
        to_local("interval_start", tz).alias("interval_start_local"),
        "resolution_minutes",
        "price_sek_kwh",
        "price_eur_kwh",
        "eur_sek_rate",
    )


def hourly_fact(intervals: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """One row per zone and UTC hour. Every aggregate is combined on the map side first."""
    hour_start = hour_floor("interval_start")
    return (
        intervals.groupBy("zone", "delivery_date", hour_start.alias("hour_start"))
        .agg(
            F.avg("price_sek_kwh").alias("price_sek_kwh"),
            F.min("price_sek_kwh").alias("min_interval_price"),
            F.max("price_sek_kwh").alias("max_interval_price"),
            F.count("*").alias("n_intervals"),
        )
        .withColumn("hour_local", local_hour("hour_start", tz))
    )


def weather_fact(points: DataFrame) -> DataFrame:
    """Zone-hour weather: the mean of the zone's points."""
    return points.groupBy("zone", "valid_at").agg(
        F.avg("temperature_2m").alias("temperature_c"),
        F.avg("wind_speed_100m").alias("wind_100m_ms"),
        F.avg("shortwave_radiation").alias("solar_w_m2"),
        F.avg("cloud_cover").alias("cloud_cover_pct"),
        F.count("*").alias("n_points"),
    )


def daily_zone_stats(intervals: DataFrame, calendar: DataFrame) -> DataFrame:
    """Daily price profile per zone.

    Aggregates first, so the calendar joins one row per zone-day instead of every interval.
    The cheapest and dearest interval are the earliest of equals.
    """
    price, at = F.col("price_sek_kwh"), F.col("interval_start_local")
    daily = intervals.groupBy("delivery_date", "zone").agg(
        F.min("resolution_minutes").alias("resolution_minutes"),
        F.avg(price).alias("mean_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        (F.max(price) - F.min(price)).alias("intraday_spread"),
        F.count_if(price < 0).alias("negative_intervals"),
        F.min(F.struct(price, at))["interval_start_local"].alias("cheapest_interval_local"),
        F.min(F.struct(-price, at))["interval_start_local"].alias("dearest_interval_local"),
    )
    days = calendar.select(F.col("date_day").alias("delivery_date"), "is_workday")
    return daily.join(days, "delivery_date")
