"""Writers: dynamic partition overwrite, write-once append, incremental merge and report JSON.

All of them go through Spark's committer, so a lost executor or a retried task leaves no
half-written partition behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.config import REPUBLISH_DAYS
from zonecast.functions.numeric import json_ready
from zonecast.session import Scratch, is_missing


def overwrite_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace exactly the partitions present in ``df``.

    REBALANCE lets AQE split a partition value that holds too much for one task and merge tiny
    ones, instead of one task (and one file) per value.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


# Parts of a write-once log, by the hash of the key.
BUCKETS = 64


def bucket_name(buckets: int) -> str:
    """The partition column; its name tells the number, as a log of another number would hide its keys."""
    return f"bucket_of_{buckets}"


def bucket_of(buckets: int, *key: Column | str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _log(spark: SparkSession, path: str, buckets: int) -> DataFrame | None:
    """A write-once log, or None before the first write."""
    try:
        log = spark.read.parquet(path)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return None
    if bucket_name(buckets) not in log.columns:
        raise ValueError(f"{path} is not a write-once log of {buckets} buckets")
    return log


def logged(spark: SparkSession, path: str, buckets: int, touched: list[int]) -> DataFrame | None:
    """The part of a write-once log in the given buckets, or None before the first write. Other buckets are not read."""
    log = _log(spark, path, buckets)
    return None if log is None else log.where(F.col(bucket_name(buckets)).isin(touched))


def is_logged(spark: SparkSession, path: str, buckets: int = BUCKETS, **key: object) -> bool:
    """Whether a key (column = value, in the order it was written by) is in a write-once log."""
    log = _log(spark, path, buckets)
    if log is None:
        return False
    values = {name: F.lit(value).cast(log.schema[name].dataType) for name, value in key.items()}
    own = spark.range(1).select(bucket_of(buckets, *values.values())).first()[0]
    found = log.where(F.col(bucket_name(buckets)) == own)
    for name, value in values.items():
        found = found.where(F.col(name) == value)
    return not found.isEmpty()


def write_once(df: DataFrame, path: str, *key: str, buckets: int = BUCKETS) -> None:
    """Append the rows whose key is new and leave the rest untouched: what is written is never rewritten.

    The log is partitioned by a hash of the key. A batch looks only into the buckets that its own keys fall in, and there only at the key
    columns. The batch is stored first, so it is worked out once and stays the same while it is compared and written.
    """
    spark, bucket = df.sparkSession, bucket_name(buckets)
    with Scratch(spark, "write-once") as work:
        batch = work.store(df.withColumn(bucket, bucket_of(buckets, *key)), "batch")
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]
        known = logged(spark, path, buckets, touched)
        if known is not None:
            batch = batch.join(known.select(bucket, *key), [bucket, *key], "left_anti")
        batch.hint("rebalance", bucket).write.mode("append").partitionBy(bucket).parquet(path)


def merge_recent(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    day: str = "delivery_date",
    recompute_days: int = REPUBLISH_DAYS,
) -> None:
    """Rebuild the newest days of a table partitioned by ``day`` from their source rows.

    The cut-off is the newest day already in the table minus ``recompute_days``, so one more
    date than ``recompute_days`` is rebuilt. An empty or missing table gets a full build. Older
    corrections need a full refresh, and a date that vanished from the source keeps its rows.
    """
    try:
        newest = spark.read.parquet(path).agg(F.max(day).alias("d")).first()["d"]
    except AnalysisException as error:
        if not is_missing(error):
            raise
        newest = None
    if newest is not None:
        source = source.where(F.col(day) >= F.date_sub(F.lit(newest), recompute_days))
    overwrite_partitions(build(source), path, day)


def write_report(df: DataFrame, path: str) -> None:
    """A report block as JSON lines, cleaned for a JSON reader."""
    json_ready(df).write.mode("overwrite").json(path)
