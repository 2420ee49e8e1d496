"""Structured Streaming forms of the daily batch steps.

Inputs are folders that new files land in; every job runs on ``availableNow`` by default, so the
same code serves a scheduled catch-up and a continuous run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.functions.clock import as_utc, as_zoned, hour_floor, local_date
from zonecast.functions.numeric import inside
from zonecast.operators.validate import check_price_days, day_status, valid_intervals
from zonecast.session import Scratch
from zonecast.sources.sinks import overwrite_partitions, write_once
from zonecast.sources.tables import read_or_empty

LATE = "3 days"


def landing(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None, glob: str | None = None
) -> DataFrame:
    """Stream over the Parquet files of a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def append_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run the stream over what has landed and append its output to ``path``.

    A checkpoint keeps the number of state partitions of its first run, the session's
    spark.sql.shuffle.partitions: start a stream with the number that its full state needs.
    """
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def each_batch_available(
    stream: DataFrame, write: Callable[[DataFrame], None], checkpoint: str, mode: str = "append"
) -> None:
    """As above, but hand every micro-batch to ``write``, which must be safe to repeat."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(lambda batch, _: write(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def hourly_rollup(
    intervals: DataFrame, time: str = "interval_start", version: str = "published", late: str = LATE
) -> DataFrame:
    """Hourly prices that still take in intervals republished up to ``late`` behind the newest.

    An interval counts once, with the price of its highest ``version``, however often it is published. The state
    holds one row for each interval of the open hours. An hour is appended once the watermark has passed its
    end. Watermarks need a zoned timestamp; the conversion there and back keeps the instant.
    """
    newest = (
        intervals.withColumn("event_time", as_zoned(time))
        .withWatermark("event_time", late)
        .groupBy("zone", F.window("event_time", "1 hour").alias("hour"), time)
        .agg(F.max_by("price_sek_kwh", version).alias("price_sek_kwh"))
    )
    return (
        newest.groupBy("zone", F.window(F.window_time("hour"), "1 hour").alias("hour"))
        .agg(
            F.avg("price_sek_kwh").alias("price_sek_kwh"),
            F.min("price_sek_kwh").alias("min_interval_price"),
            F.max("price_sek_kwh").alias("max_interval_price"),
            F.count("*").alias("n_intervals"),
        )
        .select(
            "zone",
            as_utc("hour.start").alias("hour_start"),
            "price_sek_kwh",
            "min_interval_price",
            "max_interval_price",
            "n_intervals",
        )
    )


def score_on_arrival(forecasts: DataFrame, actuals: DataFrame, late: str = LATE) -> DataFrame:
    """Score a forecast hour when its price arrives: stream-stream join on zone and hour.

    Both watermarks bound the state: an hour waits at most ``late`` for its other side.
    """
    f = forecasts.withColumn("forecast_time", as_zoned("hour_start")).withWatermark(
        "forecast_time", late
    )
    a = (
        actuals.select(
            F.col("zone").alias("actual_zone"),
            as_zoned("hour_start").alias("actual_time"),
            F.col("price_sek_kwh").alias("actual"),
        ).withWatermark("actual_time", late)
    )
    same = (F.col("zone") == F.col("actual_zone")) & (F.col("forecast_time") == F.col("actual_time"))
    return f.join(a, same).select(
        "zone",
        "hour_start",
        "actual",
        F.abs(F.col("q50") - F.col("actual")).alias("error"),
        inside(F.col("actual"), F.col("q10"), F.col("q90")).alias("inside"),
    )


def score_or_wait(forecasts: DataFrame, actuals: DataFrame, late: str = LATE) -> DataFrame:
    """Every forecast hour once: ``scored`` when its price arrives, ``waiting`` when none has come until the watermark passes it.

    The outer form of ``score_on_arrival``. A forecast stays in the state until its price is there or both streams have moved
    ``late`` beyond its hour; only then is it known to have no price, and it leaves with empty scores.
    """
    f = forecasts.withColumn("forecast_time", as_zoned("hour_start")).withWatermark("forecast_time", late)
    a = actuals.select(
        F.col("zone").alias("actual_zone"),
        as_zoned("hour_start").alias("actual_time"),
        F.col("price_sek_kwh").alias("actual"),
    ).withWatermark("actual_time", late)
    same = (F.col("zone") == F.col("actual_zone")) & (F.col("forecast_time") == F.col("actual_time"))
    return f.join(a, same, "left_outer").select(
        "zone",
        "hour_start",
        F.when(F.col("actual_zone").isNull(), F.lit("waiting")).otherwise(F.lit("scored")).alias("status"),
        "actual",
        F.abs(F.col("q50") - F.col("actual")).alias("error"),
        inside(F.col("actual"), F.col("q10"), F.col("q90")).alias("inside"),
    )


INTERVAL_STATE = "zone string, interval_start timestamp_ntz, price_sek_kwh double, published int, delivery_date date"


def changed_intervals(
    intervals: DataFrame, time: str = "interval_start", version: str = "published", late: str = LATE
) -> DataFrame:
    """In update mode, the intervals that a batch adds or corrects, each at its highest version so far.

    The state holds a row for each interval younger than the watermark; older corrections are too late here and need a full refresh.
    """
    return (
        intervals.withColumn("event_time", as_zoned(time))
        .withWatermark("event_time", late)
        .groupBy("zone", "event_time")
        .agg(F.max_by("price_sek_kwh", version).alias("price_sek_kwh"), F.max(version).cast("int").alias("published"))
        .select("zone", as_utc("event_time").alias("interval_start"), "price_sek_kwh", "published")
    )


def merge_hours(intervals: str, hours: str) -> Callable[[DataFrame], None]:
    """Batch writer that shows corrections at once: changed intervals go into their day, and the day's hours are made anew.

    Both tables are partitioned by delivery date. A batch reads and replaces the days it touches and no other; an interval that is stored
    already stays unless the batch has a version at least as high, so a repeated batch changes nothing.
    """

    def write(batch: DataFrame) -> None:
        spark = batch.sparkSession
        with Scratch(spark, "merge-hours") as work:
            changed = work.store(batch.withColumn("delivery_date", local_date("interval_start")), "changed")
            days = [r[0] for r in changed.select("delivery_date").distinct().collect()]
            if not days:
                return
            known = read_or_empty(spark, intervals, INTERVAL_STATE).where(F.col("delivery_date").isin(days))
            both = known.withColumn("_new", F.lit(0)).unionByName(changed.withColumn("_new", F.lit(1)))
            newest = both.groupBy("delivery_date", "zone", "interval_start").agg(
                F.max(F.struct("published", "_new", "price_sek_kwh")).alias("row")
            )
            merged = newest.select("zone", "interval_start", "row.price_sek_kwh", "row.published", "delivery_date")
            merged = work.store(merged, "merged")
            overwrite_partitions(merged, intervals, "delivery_date")
            price = F.col("price_sek_kwh")
            hourly = merged.groupBy("zone", "delivery_date", hour_floor("interval_start").alias("hour_start")).agg(
                F.avg(price).alias("price_sek_kwh"),
                F.min(price).alias("min_interval_price"),
                F.max(price).alias("max_interval_price"),
                F.count("*").alias("n_intervals"),
            )
            overwrite_partitions(hourly, hours, "delivery_date")

    return write


def keep_first(path: str, order: str, *key: str) -> Callable[[DataFrame], None]:
    """Batch writer under which the first snapshot of a key wins, for good.

    Within a batch the earliest row wins; keys written by earlier batches are left alone. A
    repeated batch finds its own keys already there, so it adds nothing.
    """

    def write(batch: DataFrame) -> None:
        columns = [c for c in batch.columns if c not in key]
        row = F.struct(order, *[c for c in columns if c != order])
        first = batch.groupBy(*key).agg(F.min(row).alias("row")).select(*key, "row.*")
        write_once(first.select(*batch.columns), path, *key)

    return write


def validate_batches(prices: str, status: str) -> Callable[[DataFrame], None]:
    """Batch writer for raw days (zone, day, source, payload): good rows and the day status.

    Both tables are partitioned by zone and day, so a batch replaces the status of exactly the days it holds. A day
    without a good row leaves its older price partition in place; ``current_prices`` is how prices are read,
    and leaves those days out.
    """

    def write(batch: DataFrame) -> None:
        # A day landed twice in one batch counts once: the later source name wins.
        newest = F.row_number().over(Window.partitionBy("zone", "day").orderBy(F.desc("source")))
        days = batch.withColumn("_n", newest).where(F.col("_n") == 1).drop("_n")
        checked = check_price_days(days).persist()
        try:
            overwrite_partitions(valid_intervals(checked), prices, "zone", "delivery_date")
            overwrite_partitions(day_status(checked), status, "zone", "day")
        finally:
            checked.unpersist()

    return write


def current_prices(prices: DataFrame, status: DataFrame) -> DataFrame:
    """The prices of the days whose latest version is good."""
    bad = status.where(F.col("reason").isNotNull()).select(
        F.col("zone").alias("_zone"), F.col("day").alias("_day")
    )
    return prices.join(
        bad, (F.col("zone") == F.col("_zone")) & (F.col("delivery_date") == F.col("_day")), "left_anti"
    )
