"""The build: raw files -> validated tables -> star schema -> feature table.

Every layer is a stored table. The next layer starts from files, so lineage stays short, shared
inputs are computed once, and a lost executor costs tasks, not the build.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast import schemas
from zonecast.config import NEIGHBOUR_ZONES, NORTHERN_ZONES, WEATHER_POINTS
from zonecast.operators import ingest, marts, quality, validate
from zonecast.operators.features import feature_table
from zonecast.sources import raw, sinks, tables
from zonecast.sources.generators import calendar, days_between, point_registry, zone_table
from zonecast.session import is_missing, materialise


def built_months(spark: SparkSession, status_path: str) -> DataFrame:
    """(zone, month, built_at) from the write times of the status table."""
    try:
        files = spark.read.schema(schemas.DAY_STATUS).parquet(status_path)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return spark.createDataFrame([], "zone string, month string, built_at timestamp")
    return files.groupBy("zone", "month").agg(
        F.min("_metadata.file_modification_time").alias("built_at")
    )


# More zone-years than this to rebuild at once are read by one pattern for all.
MAX_PATTERNS = 2000


def stale_price_days(spark: SparkSession, raw_root: str, out: str) -> DataFrame | None:
    """The documents of the zone-months to rebuild; None if there are none, or no raw folder yet.

    What is stale follows from the listing alone: names and write times. The read is then given only the folders and months
    that hold it, so an incremental build opens what has landed and nothing else. The semi-join on the groups stays, as the
    patterns only narrow the read.
    """
    try:
        files = raw.list_files(spark, raw_root)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return None
    # At most a row a zone-month that changed.
    stale = materialise(
        ingest.stale_groups(files, built_months(spark, f"{out}/price_status")).select("zone", "month"), "stale-months"
    )
    patterns = [r["pattern"] for r in raw.price_patterns(stale).limit(MAX_PATTERNS + 1).collect()]
    if not patterns:
        return None
    days = raw.read_price_days(spark, raw_root, patterns if len(patterns) <= MAX_PATTERNS else None)
    return days.withColumn("month", raw.month_of("day")).join(stale, ["zone", "month"], "left_semi").drop("month")


def build_prices(spark: SparkSession, raw_root: str, out: str) -> dict[str, int]:
    """Validate the zone-months with new files; prices and day status per (zone, month).

    A month whose days all fail leaves its older price partition in place, as a failed rebuild
    must not delete what was valid; its status rows say what is quarantined now.
    """
    days = stale_price_days(spark, raw_root, out)
    if days is None:
        return {"months_built": 0, "days_ok": 0, "days_quarantined": 0}
    checked = validate.check_price_days(days).persist()
    try:
        stats = validate.build_stats(checked).first().asDict()
        if stats["days_ok"] + stats["days_quarantined"]:
            prices = validate.valid_intervals(checked).withColumn("month", raw.month_of("delivery_date"))
            sinks.overwrite_partitions(prices, f"{out}/prices", "zone", "month")
            sinks.overwrite_partitions(validate.day_status(checked), f"{out}/price_status", "zone", "month")
    finally:
        checked.unpersist()
    return stats


def stale_documents(spark: SparkSession, root: str, status_path: str) -> list[str]:
    """Paths of the weather documents never built, or newer than their build; none if nothing has landed yet.

    One document a month or issue day, so the calendar bounds the list.
    """
    try:
        landed = raw.list_documents(spark, root)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return []
    try:
        built = (
            spark.read.schema("source string, reason string, name string")
            .parquet(status_path)
            .groupBy("name")
            .agg(F.min("_metadata.file_modification_time").alias("built_at"))
        )
    except AnalysisException as error:
        if not is_missing(error):
            raise
        built = spark.createDataFrame([], "name string, built_at timestamp")
    stale = landed.join(built, "name", "left").where(F.col("built_at").isNull() | (F.col("modified") > F.col("built_at")))
    return [r["path"] for r in stale.select("path").collect()]


def _build_weather(
    spark: SparkSession,
    read: Callable[[SparkSession, str, list[str]], DataFrame],
    root: str,
    out: str,
    table: str,
    *extra: str,
) -> int:
    """Validate new weather documents; rows and status are partitioned by document name. Only stale files are opened."""
    registry = point_registry(spark)
    status_path = f"{out}/{table}_status"
    paths = stale_documents(spark, root, status_path)
    if not paths:
        return 0
    checked = validate.check_weather(
        read(spark, root, paths), registry, len(WEATHER_POINTS), "name", "source", *extra
    ).persist()
    try:
        rows = validate.flatten_weather(checked, registry, "name", *extra)
        sinks.overwrite_partitions(rows, f"{out}/{table}", "name")
        sinks.overwrite_partitions(
            checked.select("name", "source", "reason"), status_path, "name"
        )
        return checked.where(F.col("reason").isNull()).count()
    finally:
        checked.unpersist()


def build_weather_archive(spark: SparkSession, raw_root: str, out: str) -> int:
    return _build_weather(spark, raw.read_weather_archive, raw_root, out, "weather_archive")


def build_weather_snapshots(spark: SparkSession, raw_root: str, out: str) -> int:
    """Snapshots keep their issue day and fetch time; a broken document is quarantined too."""
    return _build_weather(spark, raw.read_weather_snapshots, raw_root, out, "weather_forecast", "issue_date", "fetched_at")


def build_validated(spark: SparkSession, raw_root: str, out: str) -> dict[str, int]:
    stats = build_prices(spark, f"{raw_root}/prices", out)
    stats["weather_months_built"] = build_weather_archive(spark, f"{raw_root}/weather/archive", out)
    stats["weather_forecasts_built"] = build_weather_snapshots(
        spark, f"{raw_root}/weather/forecast", out
    )
    return stats


def build_marts(spark: SparkSession, out: str, full_refresh: bool = False) -> None:
    """Interval, hourly and weather facts, the calendar and the daily mart.

    Only the hourly fact is incremental; a full refresh rewrites all of it.
    """
    prices = tables.scan_prices(spark, f"{out}/prices")
    intervals = marts.interval_fact(prices)
    hourly_path = f"{out}/fct_price_hourly"
    if full_refresh:
        sinks.overwrite_partitions(marts.hourly_fact(intervals), hourly_path, "delivery_date")
    else:
        sinks.merge_recent(spark, hourly_path, intervals, marts.hourly_fact)
    weather = tables.scan_weather_archive(spark, f"{out}/weather_archive")
    marts.weather_fact(weather).write.mode("overwrite").parquet(f"{out}/fct_weather_hourly")
    bounds = intervals.agg(
        F.min("delivery_date").alias("first"), F.max("delivery_date").alias("last")
    )
    days = calendar(days_between(bounds, "first", "last", extra_days=7))
    days.write.mode("overwrite").parquet(f"{out}/dim_date")
    stats = marts.daily_zone_stats(intervals, spark.read.parquet(f"{out}/dim_date"))
    stats.write.mode("overwrite").parquet(f"{out}/mart_daily_zone_stats")


def build_zones(spark: SparkSession, seed: str, out: str) -> dict[str, int]:
    """The zone dimension from its declared CSV; lines that do not fit are kept aside with the reason."""
    rows, rejects = tables.read_seed(spark, seed, schemas.ZONES_SEED, "zone")
    rows.write.mode("overwrite").parquet(f"{out}/dim_zone")
    rejects.write.mode("overwrite").parquet(f"{out}/dim_zone_rejects")
    return {"zones": spark.read.parquet(f"{out}/dim_zone").count(), "rejects": spark.read.parquet(f"{out}/dim_zone_rejects").count()}


def zones_of(spark: SparkSession, out: str) -> DataFrame:
    """The built zone dimension, or the declared zones where no seed was given."""
    try:
        return spark.read.schema(schemas.ZONES_SEED).parquet(f"{out}/dim_zone")
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return zone_table(spark)


def build_features(
    spark: SparkSession,
    out: str,
    neighbours: dict[str, str] = NEIGHBOUR_ZONES,
    northern: tuple[str, ...] = NORTHERN_ZONES,
) -> DataFrame:
    table = feature_table(
        spark.read.parquet(f"{out}/fct_price_hourly"),
        zones_of(spark, out),
        spark.read.parquet(f"{out}/dim_date"),
        spark.read.parquet(f"{out}/fct_weather_hourly"),
        tables.scan_weather_snapshots(spark, f"{out}/weather_forecast"),
        neighbours,
        northern,
    )
    path = f"{out}/feat_price_hourly"
    (
        table.hint("rebalance", "delivery_date")
        .write.mode("overwrite")
        .partitionBy("delivery_date")
        .parquet(path)
    )
    return spark.read.parquet(path)


def run_tests(spark: SparkSession, out: str) -> DataFrame:
    """The 22 data tests of a build: (test, failures)."""
    return quality.warehouse_tests(
        zones=zones_of(spark, out),
        days=spark.read.parquet(f"{out}/dim_date"),
        intervals=marts.interval_fact(tables.scan_prices(spark, f"{out}/prices")),
        hourly=spark.read.parquet(f"{out}/fct_price_hourly"),
        weather=spark.read.parquet(f"{out}/fct_weather_hourly"),
        stats=spark.read.parquet(f"{out}/mart_daily_zone_stats"),
        features=spark.read.parquet(f"{out}/feat_price_hourly"),
    )


def build(
    spark: SparkSession, raw_root: str, out: str, full_refresh: bool = False, zone_seed: str | None = None
) -> tuple[dict[str, int], DataFrame]:
    """Everything from raw files to features; returns the build stats and the feature table."""
    if zone_seed:
        build_zones(spark, zone_seed, out)
    stats = build_validated(spark, raw_root, out)
    build_marts(spark, out, full_refresh)
    return stats, build_features(spark, out)


# Marts are stored tables; staging and facts read from files are views over them.
TABLES = (
    "fct_price_hourly",
    "fct_weather_hourly",
    "dim_date",
    "mart_daily_zone_stats",
    "feat_price_hourly",
)


def register_views(spark: SparkSession, out: str) -> None:
    """Temporary views over the warehouse, for ``sources.tables.query``."""
    for name in TABLES:
        spark.read.parquet(f"{out}/{name}").createOrReplaceTempView(name)
    prices = tables.scan_prices(spark, f"{out}/prices")
    prices.createOrReplaceTempView("stg_prices")
    marts.interval_fact(prices).createOrReplaceTempView("fct_price_interval")
    zones_of(spark, out).createOrReplaceTempView("dim_zone")
    tables.scan_weather_archive(spark, f"{out}/weather_archive").createOrReplaceTempView(
        "stg_weather_archive"
    )
    tables.scan_weather_snapshots(spark, f"{out}/weather_forecast").createOrReplaceTempView(
        "stg_weather_forecast"
    )


def interval_prices(spark: SparkSession, out: str, first: date, last: date) -> DataFrame:
    return tables.load_interval_prices(tables.scan_prices(spark, f"{out}/prices"), first, last)
