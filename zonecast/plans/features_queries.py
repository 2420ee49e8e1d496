"""Queries over the feature operators, up to the whole feature table and its leak test."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.clock import local_date
from zonecast.operators import features as ft
from zonecast.operators.marts import weather_fact
from zonecast.operators.quality import leak_report
from zonecast.plans import panels
from zonecast.plans.shape import big, rounded, six
from zonecast.plans.sqltext import (
    DAILY_PANEL,
    HOLIDAYS,
    HOURLY,
    INTERVALS,
    R6,
    WEATHER,
    features,
    with_ctes,
)
from zonecast.session import materialise
from zonecast.sources.tables import driver_table

EVENT_YEARS = HOLIDAYS("select unnest([2023, 2024, 2025]) as y")
SHOCK_DAY = date(2024, 1, 15)


def shaped(df: DataFrame) -> DataFrame:
    """Every column in the comparison types."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            out.append(rounded(f.name).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.LongType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(out)


def seasonal_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = panels.stored_hourly(spark, sf_dir)
    lagged = hours.join(ft.seasonal_lags(hours), ["zone", "delivery_date", "hour_local"], "left")
    return lagged.select("zone", "hour_start", *big("hour_local"), *six("lag_1d", "lag_2d", "lag_7d"))


SEASONAL_LAGS = with_ctes(
    INTERVALS,
    HOURLY,
    select=f"""
    select t.zone, t.hour_start, cast(t.hour_local as bigint) as hour_local,
           {R6('l1.price_sek_kwh')} as lag_1d, {R6('l2.price_sek_kwh')} as lag_2d, {R6('l7.price_sek_kwh')} as lag_7d
    from hourly as t
    """
    + "\n".join(
        f"""left join hourly as l{k} on l{k}.zone = t.zone and l{k}.hour_local = t.hour_local
            and l{k}.delivery_date = t.delivery_date - {k}"""
        for k in (1, 2, 7)
    ),
)


def repeated_hour_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter hours folded onto their local hour, as the autumn day's repeated hour is."""
    quarters = panels.intervals(spark, sf_dir).withColumn(
        "hour_local", F.hour("interval_start_local")
    )
    return ft.repeated_hour_mean(quarters).select(
        "zone", "delivery_date", *big("hour_local", "n_hours"), *six("price")
    )


REPEATED_HOUR_MEAN = with_ctes(
    INTERVALS,
    select=f"""
    select zone, delivery_date, hour(interval_start_local) as hour_local, count(*) as n_hours,
           {R6('avg(price_sek_kwh)')} as price
    from intervals group by all""",
)


def _trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.trailing(ft.daily_profile(panels.daily_panel(spark, sf_dir)))


def trailing_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trailing(spark, sf_dir).select("zone", "delivery_date", *six("day_mean", "week_mean"))


TRAILING_WEEK = with_ctes(
    DAILY_PANEL,
    select=f"""
    select zone, delivery_date, {R6('price_sek_kwh')} as day_mean,
           {R6('''avg(price_sek_kwh) over (partition by zone order by delivery_date
                  range between interval 6 days preceding and current row)''')} as week_mean
    from hourly""",
)


def day_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trailing(spark, sf_dir).select("zone", "delivery_date", *six("day_mean_change"))


DAY_CHANGE = with_ctes(
    DAILY_PANEL,
    select=f"""
    select zone, delivery_date,
           {R6('price_sek_kwh - lag(price_sek_kwh) over (partition by zone order by delivery_date)')} as day_mean_change
    from hourly""",
)


def daily_spread_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.daily_profile(panels.hourly(spark, sf_dir)).select(
        "zone", "delivery_date", *six("day_mean", "day_min", "day_max", "day_std", "day_peak_mean")
    )


DAILY_SPREAD_STATS = with_ctes(
    INTERVALS,
    HOURLY,
    select=f"""
    select zone, delivery_date, {R6('avg(price_sek_kwh)')} as day_mean, {R6('min(price_sek_kwh)')} as day_min,
           {R6('max(price_sek_kwh)')} as day_max, {R6('stddev_samp(price_sek_kwh)')} as day_std,
           {R6('avg(price_sek_kwh) filter (where hour_local between 17 and 20)')} as day_peak_mean
    from hourly group by all""",
)


def cross_zone_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = {"1-URGENT": "urgent_mean", "3-MEDIUM": "medium_mean", "5-LOW": "low_mean"}
    daily = ft.daily_profile(panels.daily_panel(spark, sf_dir))
    return ft.cross_zone(daily, zones).select("delivery_date", *six(*zones.values()))


CROSS_ZONE_PIVOT = with_ctes(
    DAILY_PANEL,
    select=f"""
    select delivery_date, {R6("avg(price_sek_kwh) filter (where zone = '1-URGENT')")} as urgent_mean,
           {R6("avg(price_sek_kwh) filter (where zone = '3-MEDIUM')")} as medium_mean,
           {R6("avg(price_sek_kwh) filter (where zone = '5-LOW')")} as low_mean
    from hourly where zone in ('1-URGENT', '3-MEDIUM', '5-LOW') group by all""",
)


def mean_of_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = panels.weather_hourly(spark, sf_dir)
    return ft.mean_over_zones(weather, panels.EVENT_NORTH, "wind_100m_ms", "north_wind_ms").select(
        "valid_at", *six("north_wind_ms")
    )


MEAN_OF_MEANS = with_ctes(
    INTERVALS,
    HOURLY,
    WEATHER,
    select=f"""
    select valid_at, {R6('avg(wind_100m_ms)')} as north_wind_ms
    from (select zone, hour as valid_at, avg(wind_speed_100m) as wind_100m_ms from event_weather group by all)
    where zone in ('click', 'error') group by all""",
)


def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped lines of the newest ship day on or before the last order day, by return flag."""
    cutoff = (
        driver_table(spark, sf_dir, "orders").agg(F.max(F.col("o_orderdate").cast("date"))).scalar()
    )
    lines = driver_table(spark, sf_dir, "lineitem").withColumn(
        "issue_date", F.col("l_shipdate").cast("date")
    )
    return (
        ft.snapshot_as_of(lines, cutoff)
        .groupBy("issue_date", F.col("l_returnflag").alias("point"))
        .agg(F.count("*").alias("lines"), panels.exact_mean("l_discount").alias("mean_discount"))
        .select("issue_date", "point", "lines", *six("mean_discount"))
    )


SNAPSHOT_AS_OF = f"""
    select cast(l_shipdate as date) as issue_date, l_returnflag as point, count(*) as lines,
           {R6('cast(sum(cast(l_discount as decimal(18,2))) as double) / count(*)')} as mean_discount
    from lineitem
    where cast(l_shipdate as date) = (
      select max(cast(l_shipdate as date)) from lineitem
      where cast(l_shipdate as date) <= (select max(cast(o_orderdate as date)) from orders))
    group by all"""


def weather_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = materialise(panels.weather_points(spark, sf_dir), "weather-points")
    cutoff = ft.last_day(points.select(local_date("valid_at").alias("delivery_date")))
    spliced = ft.splice_weather(weather_fact(points), panels.as_snapshots(points), cutoff)
    return spliced.select("zone", "valid_at", "weather_source", *six(*ft.WEATHER_COLUMNS))


WEATHER_SPLICE = with_ctes(
    INTERVALS,
    HOURLY,
    WEATHER,
    select=f"""
    select zone, valid_at, weather_source, {R6('temperature_c')} as temperature_c, {R6('wind_100m_ms')} as wind_100m_ms,
           {R6('solar_w_m2')} as solar_w_m2, {R6('cloud_cover_pct')} as cloud_cover_pct
    from weather""",
)


def event_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The stored hourly panel of the events, and the feature build over such a panel."""
    hours = materialise(panels.hourly(spark, sf_dir).select(*ft.HOUR_COLUMNS), "hourly")
    points = materialise(panels.weather_points(spark, sf_dir), "weather-points")
    days, zones = panels.calendar_of(hours), panels.zones_of(hours)

    def build(panel: DataFrame) -> DataFrame:
        return ft.feature_table(
            panel,
            zones,
            days,
            weather_fact(points),
            panels.as_snapshots(points),
            neighbours=panels.EVENT_NEIGHBOURS,
            northern=panels.EVENT_NORTH,
        )

    return hours, build


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours, build = event_features(spark, sf_dir)
    return shaped(build(hours))


FEATURE_TABLE = with_ctes(
    INTERVALS, HOURLY, WEATHER, EVENT_YEARS, features("hourly", "a"), select="select * from features_a"
)


def feature_leak_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiply one day's prices by ten: its own features must not move, the next day's must."""
    hours, build = event_features(spark, sf_dir)
    return leak_report(build, hours, SHOCK_DAY)


FEATURE_LEAK_CHECK = with_ctes(
    INTERVALS,
    HOURLY,
    WEATHER,
    EVENT_YEARS,
    f"""shocked as (
        select * replace (case when delivery_date = date '{SHOCK_DAY}' then price_sek_kwh * 10
                               else price_sek_kwh end as price_sek_kwh) from hourly)""",
    features("hourly", "a"),
    features("shocked", "b"),
    f"""day_a as (select * exclude (target_price) from features_a where delivery_date = date '{SHOCK_DAY}')""",
    f"""day_b as (select * exclude (target_price) from features_b where delivery_date = date '{SHOCK_DAY}')""",
    select=f"""
    select (select count(*) from day_a) as checked_rows,
           (select count(*) from (select * from day_a except all select * from day_b))
             + (select count(*) from (select * from day_b except all select * from day_a)) as leaked_rows,
           count(*) as next_day_rows,
           count(*) filter (where abs(b.lag_1d) > abs(a.lag_1d)) as next_day_moved
    from features_a as a join features_b as b using (zone, hour_start)
    where a.delivery_date = date '{SHOCK_DAY}' + 1""",
)

QUERIES = {
    "seasonal_lags": (seasonal_lags, SEASONAL_LAGS),
    "repeated_hour_mean": (repeated_hour_mean, REPEATED_HOUR_MEAN),
    "trailing_week": (trailing_week, TRAILING_WEEK),
    "day_change": (day_change, DAY_CHANGE),
    "daily_spread_stats": (daily_spread_stats, DAILY_SPREAD_STATS),
    "cross_zone_pivot": (cross_zone_pivot, CROSS_ZONE_PIVOT),
    "mean_of_means": (mean_of_means, MEAN_OF_MEANS),
    "snapshot_as_of": (snapshot_as_of, SNAPSHOT_AS_OF),
    "weather_splice": (weather_splice, WEATHER_SPLICE),
    "feature_table": (feature_table, FEATURE_TABLE),
    "feature_leak_check": (feature_leak_check, FEATURE_LEAK_CHECK),
}
