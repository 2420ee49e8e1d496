"""Point-in-time feature table: one row per zone and target hour.

The forecast for a day is issued on the day before, so prices enter only with an offset of one
day or more; the weather of the target hour comes from the archive for history and from the
newest snapshot not younger than the last priced day for the rows still to be forecast.

Shuffle keys: hour-grain inputs join first, while the target side is narrow, then the two
day-grain inputs share one exchange on (zone, delivery_date). Tables with one row per day or per
hour of the calendar are joined without a hint, so Spark sends them round only while they are small. ``hourly`` and
``archive`` are read by several branches and should be stored tables, as plans.warehouse does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import FIRST_FEATURE_DAY, MARKET_TZ, NEIGHBOUR_ZONES, NORTHERN_ZONES
from zonecast.functions.clock import day_start_utc, local_date, local_hour, plus_hours

HOUR_COLUMNS = ("zone", "delivery_date", "hour_start", "hour_local", "price_sek_kwh")
WEATHER_COLUMNS = ("temperature_c", "wind_100m_ms", "solar_w_m2", "cloud_cover_pct")


def last_day(hourly: DataFrame) -> Column:
    """Newest priced day, as a scalar subquery."""
    return hourly.agg(F.max("delivery_date")).scalar()


def next_day_hours(hourly: DataFrame, zones: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """Unlabelled rows for the day after the last priced one.

    26 candidate hours cover the longest local day; only those inside the day stay.
    """
    day = zones.select("zone", F.date_add(last_day(hourly), 1).alias("delivery_date"))
    candidates = day.select(
        "zone", "delivery_date", F.explode(F.sequence(F.lit(0), F.lit(25))).alias("k")
    ).withColumn("hour_start", plus_hours(day_start_utc("delivery_date", tz), F.col("k")))
    return candidates.where(local_date("hour_start", tz) == F.col("delivery_date")).select(
        "zone",
        "delivery_date",
        "hour_start",
        local_hour("hour_start", tz).alias("hour_local"),
        F.lit(None).cast("double").alias("price_sek_kwh"),
    )


def repeated_hour_mean(hourly: DataFrame) -> DataFrame:
    """One price per local hour: the autumn day's repeated hour is averaged."""
    return hourly.groupBy("zone", "delivery_date", "hour_local").agg(
        F.avg("price_sek_kwh").alias("price"), F.count("*").alias("n_hours")
    )


def seasonal_lags(hourly: DataFrame, lags: tuple[int, ...] = (1, 2, 7)) -> DataFrame:
    """lag_<k>d per (zone, target day, local hour).

    Every source row is sent to the days it is a lag of, so one aggregation replaces a join per
    lag and also averages the repeated autumn hour.
    """
    sent = hourly.select(
        "zone",
        "hour_local",
        "price_sek_kwh",
        "delivery_date",
        F.explode(F.array(*[F.lit(k) for k in lags])).alias("lag"),
    )
    return (
        sent.withColumn("delivery_date", F.date_add("delivery_date", F.col("lag")))
        .groupBy("zone", "delivery_date", "hour_local")
        .agg(
            *[
                F.avg(F.when(F.col("lag") == k, F.col("price_sek_kwh"))).alias(f"lag_{k}d")
                for k in lags
            ]
        )
    )


def daily_profile(hourly: DataFrame) -> DataFrame:
    price = F.col("price_sek_kwh")
    return hourly.groupBy("zone", "delivery_date").agg(
        F.avg(price).alias("day_mean"),
        F.min(price).alias("day_min"),
        F.max(price).alias("day_max"),
        F.stddev_samp(price).alias("day_std"),
        F.avg(F.when(F.col("hour_local").between(17, 20), price)).alias("day_peak_mean"),
    )


def trailing(daily: DataFrame) -> DataFrame:
    """Mean of the last seven calendar days, and the change against the previous present day.

    A window partition holds one row per calendar day of a zone, whatever the input volume.
    """
    by_zone = Window.partitionBy("zone")
    week = by_zone.orderBy(F.unix_date("delivery_date")).rangeBetween(-6, 0)
    previous = F.lag("day_mean").over(by_zone.orderBy(F.unix_date("delivery_date")))
    return daily.select(
        "*",
        F.avg("day_mean").over(week).alias("week_mean"),
        (F.col("day_mean") - previous).alias("day_mean_change"),
    )


def cross_zone(daily: DataFrame, neighbours: dict[str, str]) -> DataFrame:
    """Daily means of chosen zones as columns, one row per day."""
    return daily.where(F.col("zone").isin(*neighbours)).groupBy("delivery_date").agg(
        *[
            F.avg(F.when(F.col("zone") == zone, F.col("day_mean"))).alias(name)
            for zone, name in neighbours.items()
        ]
    )


def snapshot_as_of(snapshots: DataFrame, cutoff: Column, name: str = "issue_date") -> DataFrame:
    """Rows of the newest snapshot taken on or before the cut-off."""
    newest = snapshots.where(F.col(name) <= cutoff).agg(F.max(name)).scalar()
    return snapshots.where(F.col(name) == newest)


def splice_weather(
    archive: DataFrame, snapshots: DataFrame, cutoff: Column, tz: str = MARKET_TZ
) -> DataFrame:
    """Archived weather up to the cut-off day, the as-of snapshot after it."""
    day = local_date("valid_at", tz)
    past = archive.select("zone", "valid_at", *WEATHER_COLUMNS).where(day <= cutoff)
    ahead = (
        snapshot_as_of(snapshots, cutoff)
        .where(day > cutoff)
        .groupBy("zone", "valid_at")
        .agg(
            F.avg("temperature_2m").alias("temperature_c"),
            F.avg("wind_speed_100m").alias("wind_100m_ms"),
            F.avg("shortwave_radiation").alias("solar_w_m2"),
            F.avg("cloud_cover").alias("cloud_cover_pct"),
        )
    )
    return past.withColumn("weather_source", F.lit("archive")).unionByName(
        ahead.withColumn("weather_source", F.lit("forecast"))
    )


def mean_over_zones(weather: DataFrame, zones: tuple[str, ...], value: str, name: str) -> DataFrame:
    """Mean of the zone means, one row per hour."""
    return weather.where(F.col("zone").isin(*zones)).groupBy("valid_at").agg(F.avg(value).alias(name))


def weather_day(weather: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    return weather.groupBy("zone", local_date("valid_at", tz).alias("delivery_date")).agg(
        F.avg("temperature_c").alias("target_day_temp_c"),
        F.avg("wind_100m_ms").alias("target_day_wind_ms"),
    )


def feature_table(
    hourly: DataFrame,
    zones: DataFrame,
    calendar: DataFrame,
    archive: DataFrame,
    snapshots: DataFrame,
    neighbours: dict[str, str] = NEIGHBOUR_ZONES,
    northern: tuple[str, ...] = NORTHERN_ZONES,
    tz: str = MARKET_TZ,
) -> DataFrame:
    """The 32-column feature table: labelled history plus the rows of the next day."""
    prices = hourly.select(*HOUR_COLUMNS)
    first_target = F.date_add(
        prices.agg(F.min("delivery_date")).scalar(), FIRST_FEATURE_DAY
    )
    targets = prices.unionByName(next_day_hours(prices, zones, tz)).where(
        F.col("delivery_date") >= first_target
    )

    daily = daily_profile(prices)
    previous_day = trailing(daily).select(
        "zone",
        F.date_add("delivery_date", 1).alias("delivery_date"),
        F.col("day_mean").alias("prev_day_mean"),
        F.col("day_min").alias("prev_day_min"),
        F.col("day_max").alias("prev_day_max"),
        F.col("day_std").alias("prev_day_std"),
        F.col("day_peak_mean").alias("prev_day_peak_mean"),
        F.col("week_mean").alias("prev_week_mean"),
        F.col("day_mean_change").alias("prev_day_mean_change"),
    )
    neighbours_before = cross_zone(daily, neighbours).withColumn(
        "delivery_date", F.date_add("delivery_date", 1)
    )
    # One row per calendar day.
    day_context = calendar.select(
        F.col("date_day").alias("delivery_date"),
        "iso_dow",
        "month",
        "is_weekend",
        "is_holiday",
        "is_workday",
    ).join(neighbours_before, "delivery_date", "left")

    weather = splice_weather(archive, snapshots, last_day(prices), tz)
    weather_hour = weather.withColumn("delivery_date", local_date("valid_at", tz)).withColumnRenamed(
        "valid_at", "hour_start"
    )
    # One row per hour of the calendar.
    north = mean_over_zones(weather, northern, "wind_100m_ms", "north_wind_ms").withColumnRenamed(
        "valid_at", "hour_start"
    )
    return (
        targets.join(seasonal_lags(prices), ["zone", "delivery_date", "hour_local"], "left")
        .join(weather_hour, ["zone", "delivery_date", "hour_start"], "left")
        .join(previous_day, ["zone", "delivery_date"], "left")
        .join(weather_day(weather, tz), ["zone", "delivery_date"], "left")
        .join(day_context, "delivery_date")
        .join(north, "hour_start", "left")
        .select(
            "zone",
            "delivery_date",
            "hour_start",
            "hour_local",
            F.date_sub("delivery_date", 1).alias("issue_date"),
            F.col("price_sek_kwh").alias("target_price"),
            "iso_dow",
            "month",
            "is_weekend",
            "is_holiday",
            "is_workday",
            "lag_1d",
            "lag_2d",
            "lag_7d",
            "prev_day_mean",
            "prev_day_min",
            "prev_day_max",
            "prev_day_std",
            "prev_day_peak_mean",
            "prev_week_mean",
            "prev_day_mean_change",
            *neighbours.values(),
            *WEATHER_COLUMNS,
            "weather_source",
            "north_wind_ms",
            "target_day_temp_c",
            "target_day_wind_ms",
        )
    )


def labelled(features: DataFrame) -> DataFrame:
    return features.where(F.col("target_price").isNotNull())


def live(features: DataFrame) -> DataFrame:
    """Unlabelled rows of the earliest day still to be forecast."""
    pending = features.where(F.col("target_price").isNull())
    earliest = pending.agg(F.min("delivery_date")).scalar()
    return pending.where(F.col("delivery_date") == earliest)
