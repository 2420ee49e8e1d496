"""Landed raw files: one JSON document per file, the key in the path.

Each file becomes one row with its parsed document, so that a whole day (or a whole weather
payload) is checked inside its row and no shuffle is needed before the data is known to be good.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.clock import parse_instant

# A map keeps the difference between a key that is absent and one whose value is null.
PRICE_PAYLOAD = "array<map<string,string>>"
POINTS_PAYLOAD = (
    "array<struct<latitude:double,longitude:double,hourly:map<string,array<string>>>>"
)
SNAPSHOT_PAYLOAD = f"struct<fetched_at:string,points:{POINTS_PAYLOAD}>"

_DAY_PATH = r"([^/]+)/[^/]+/(\d{4}-\d{2}-\d{2})\.json$"
_STEM = r"([^/]+)\.json$"


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths, wholetext=True).select(
        "value",
        # The metadata column spells a path as a URI; the listing does not. A plus sign stays one.
        F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("source"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _listing(spark: SparkSession, pattern: str) -> DataFrame:
    """Path and modification time of the matching files; no content is read."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.col("modificationTime").alias("modified"))


def price_patterns(groups: DataFrame) -> DataFrame:
    """Zone-months as path patterns under the price root: (``pattern``, ``groups``), one a zone and year.

    A pattern names the zone's folder (any wildcard character in it taken literally) and the days of the
    wanted months, so the read lists and opens no other file.
    """
    literal = F.regexp_replace("zone", r"([\[\]{}*?\\,])", r"\\$1")
    months = F.array_join(F.sort_array(F.collect_set(F.substring("month", 6, 2))), ",")
    return (
        groups.where("zone is not null and month is not null")
        .groupBy("zone", F.substring("month", 1, 4).alias("year"))
        .agg(months.alias("months"), F.count_distinct("month").alias("groups"))
        .select(F.concat(literal, F.lit("/*/"), "year", F.lit("-{"), "months", F.lit("}-*.json")).alias("pattern"), "groups")
    )


def price_documents(files: DataFrame) -> DataFrame:
    """(value, source) -> (zone, day, source, payload); null payload = not a JSON array."""
    return files.select(
        F.regexp_extract("source", _DAY_PATH, 1).alias("zone"),
        F.regexp_extract("source", _DAY_PATH, 2).try_cast("date").alias("day"),
        "source",
        F.from_json("value", PRICE_PAYLOAD).alias("payload"),
    )


def read_price_days(spark: SparkSession, root: str, patterns: list[str] | None = None) -> DataFrame:
    """``root/<zone>/<year>/<day>.json``: all of them, or those that ``price_patterns`` name."""
    return price_documents(_files(spark, [f"{root}/{p}" for p in patterns or ["*/*/*.json"]]))


def list_documents(spark: SparkSession, root: str) -> DataFrame:
    """(name, modified, path) of every ``root/<name>.json``; contents are not read."""
    return _listing(spark, f"{root}/*.json").select(
        F.regexp_extract("path", _STEM, 1).alias("name"), "modified", "path"
    )


def read_weather_archive(spark: SparkSession, root: str, paths: list[str] | None = None) -> DataFrame:
    """``root/<month>.json``, or the given files -> (name, source, modified, payload)."""
    return _files(spark, paths or f"{root}/*.json").select(
        F.regexp_extract("source", _STEM, 1).alias("name"),
        "source",
        "modified",
        F.from_json("value", POINTS_PAYLOAD).alias("payload"),
    )


def read_weather_snapshots(spark: SparkSession, root: str, paths: list[str] | None = None) -> DataFrame:
    """``root/<issue day>.json``, or the given files -> (name, issue_date, fetched_at, source, modified, payload)."""
    doc = F.from_json("value", SNAPSHOT_PAYLOAD)
    return (
        _files(spark, paths or f"{root}/*.json")
        .withColumn("doc", doc)
        .select(
            F.regexp_extract("source", _STEM, 1).alias("name"),
            F.regexp_extract("source", _STEM, 1).try_cast("date").alias("issue_date"),
            parse_instant(F.col("doc.fetched_at")).alias("fetched_at"),
            "source",
            "modified",
            F.col("doc.points").alias("payload"),
        )
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path and modification time of every landed price file; contents are not read."""
    return _listing(spark, f"{root}/*/*/*.json").select(
        F.regexp_extract("path", _DAY_PATH, 1).alias("zone"),
        F.regexp_extract("path", _DAY_PATH, 2).try_cast("date").alias("day"),
        "modified",
        F.col("path").alias("source"),
    )


def month_of(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")
