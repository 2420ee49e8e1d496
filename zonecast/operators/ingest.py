"""Ingest planning as relational work: what to fetch, and what to rebuild."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.config import REFRESH_DAYS
from zonecast.functions.clock import month_start
from zonecast.sources.generators import months
from zonecast.sources.raw import month_of


def _lit(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def price_worklist(
    zones: DataFrame,
    landed: DataFrame,
    start: date | Column,
    today: date | Column,
    end: date | Column | None = None,
    refresh_days: int = REFRESH_DAYS,
) -> DataFrame:
    """(zone, day) to fetch: recent days, which can still change, and days that never landed.

    ``end`` defaults to tomorrow. ``landed`` holds (zone, day) of the files on disk.
    """
    today = _lit(today)
    last = F.date_add(today, 1) if end is None else _lit(end)
    wanted = zones.select(
        "zone", F.explode(F.sequence(_lit(start), last, F.expr("interval 1 day"))).alias("day")
    )
    have = landed.select("zone", "day").distinct().withColumn("landed", F.lit(True))
    recent = F.col("day") >= F.date_sub(today, refresh_days)
    return (
        wanted.join(have, ["zone", "day"], "left")
        .where(recent | F.col("landed").isNull())
        .select("zone", "day")
    )


def month_worklist(bounds: DataFrame, landed: DataFrame, start: str, end: str) -> DataFrame:
    """(month, month_end) to fetch between two date columns of a one-row ``bounds``.

    The month of ``end`` and the one before are always refreshed; the last month is clipped.
    """
    wanted = bounds.select(
        F.col(end).alias("range_end"),
        F.explode(months(F.col(start), F.col(end))).alias("month"),
    )
    have = landed.select("month").distinct().withColumn("landed", F.lit(True))
    fresh_from = F.add_months(month_start("range_end"), -1)
    return (
        wanted.join(have, "month", "left")
        .where(F.col("landed").isNull() | (F.col("month") >= fresh_from))
        .select("month", F.least(F.last_day("month"), F.col("range_end")).alias("month_end"))
    )


def stale_groups(files: DataFrame, built: DataFrame) -> DataFrame:
    """Zone-months never built, or with a file newer than the build.

    ``files`` is (zone, day, modified); ``built`` is (zone, month, built_at).
    """
    newest = files.groupBy("zone", month_of("day").alias("month")).agg(
        F.max("modified").alias("newest_file"), F.count("*").alias("files")
    )
    return (
        newest.join(built, ["zone", "month"], "left")
        .where(F.col("built_at").isNull() | (F.col("newest_file") > F.col("built_at")))
        .select("zone", "month", "files", "newest_file")
    )
