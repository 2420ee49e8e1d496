"""The streaming jobs run over files made from the given tables, compared with batch results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.clock import minutes_floor
from zonecast.operators.features import seasonal_lags
from zonecast.plans import ingest_queries, panels
from zonecast.plans.shape import rounded, six
from zonecast.plans.sqltext import HOURLY, INTERVALS, LOCAL, R6, with_ctes
from zonecast.session import materialise, scratch_path
from zonecast.sources.raw import PRICE_PAYLOAD
from zonecast.sources.tables import driver_table
from zonecast.streaming import jobs

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly roll-up of quarter-hour prices with a three-day watermark; open hours are not out yet.

    The intervals land in one file; a second one republishes the first of every hour at twice the price.
    """
    root = scratch_path(spark, "stream-hourly")
    quarter = F.timestamp_add(
        "MINUTE", (F.floor(F.minute("ts") / 15) * 15).cast("int"), F.date_trunc("hour", "ts").cast("timestamp_ntz")
    )
    intervals = (
        driver_table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("zone"), quarter.alias("interval_start"))
        .agg(F.max("value").alias("price_sek_kwh"))
    )
    first = intervals.withColumn("published", F.lit(1))
    second = intervals.where(F.minute("interval_start") == 0).withColumns(
        {"price_sek_kwh": 2 * F.col("price_sek_kwh"), "published": F.lit(2)}
    )
    for part in (first, second):
        part.write.mode("append").parquet(f"{root}/landing")
    landed = jobs.landing(
        spark, f"{root}/landing", "zone string, interval_start timestamp_ntz, price_sek_kwh double, published int"
    )
    jobs.append_available(jobs.hourly_rollup(landed), f"{root}/hours", f"{root}/state")
    return spark.read.parquet(f"{root}/hours").select(
        "zone",
        "hour_start",
        "n_intervals",
        *six("price_sek_kwh", "min_interval_price", "max_interval_price"),
    )


STREAM_HOURLY = f"""
    with quarters as (
        select event_type as zone, time_bucket(interval 15 minutes, ts) as start, max(value) as price
        from events group by all),
    prices as (
        select zone, start, case when extract('minute' from start) = 0 then 2 * price else price end as price
        from quarters)
    select zone, date_trunc('hour', start) as hour_start, count(*) as n_intervals,
           {R6('avg(price)')} as price_sek_kwh, {R6('min(price)')} as min_interval_price,
           {R6('max(price)')} as max_interval_price
    from prices
    where date_trunc('hour', start) + interval 1 hour <= (select max(start) - interval 3 days from prices)
    group by all"""


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts (the same hour of the day before) scored when the hourly prices arrive."""
    hours = panels.stored_hourly(spark, sf_dir)
    forecasts = (
        hours.join(seasonal_lags(hours, (1,)), ["zone", "delivery_date", "hour_local"])
        .where(F.col("lag_1d").isNotNull())
        .select(
            "zone",
            "hour_start",
            (F.col("lag_1d") - 20.0).alias("q10"),
            F.col("lag_1d").alias("q50"),
            (F.col("lag_1d") + 20.0).alias("q90"),
        )
    )
    actuals = hours.select("zone", "hour_start", "price_sek_kwh")
    root = scratch_path(spark, "stream-score")
    forecasts.write.parquet(f"{root}/forecasts")
    actuals.write.parquet(f"{root}/actuals")
    scored = jobs.score_on_arrival(
        jobs.landing(spark, f"{root}/forecasts", "zone string, hour_start timestamp_ntz, q10 double, q50 double, q90 double"),
        jobs.landing(spark, f"{root}/actuals", "zone string, hour_start timestamp_ntz, price_sek_kwh double"),
    )
    jobs.append_available(scored, f"{root}/scored", f"{root}/state")
    return spark.read.parquet(f"{root}/scored").select(
        "zone", "hour_start", *six("actual", "error", "inside")
    )


STREAM_SCORE = with_ctes(
    INTERVALS,
    HOURLY,
    select=f"""
    select h.zone, h.hour_start, {R6('h.price_sek_kwh')} as actual, {R6('abs(l.price_sek_kwh - h.price_sek_kwh)')} as error,
           {R6('cast(h.price_sek_kwh between l.price_sek_kwh - 20 and l.price_sek_kwh + 20 as double)')} as inside
    from hourly as h join hourly as l
      on l.zone = h.zone and l.delivery_date = h.delivery_date - 1 and l.hour_local = h.hour_local""",
)

# Hours of the day whose price never arrives.
SILENT = (3, 8, 13, 18, 23)


def stream_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts scored as prices arrive; those of silent hours leave as waiting once the watermark has passed them."""
    hours = panels.stored_hourly(spark, sf_dir)
    lag = F.col("lag_1d")
    forecasts = hours.join(seasonal_lags(hours, (1,)), ["zone", "delivery_date", "hour_local"]).where(lag.isNotNull()).select(
        "zone", "hour_start", (lag - 20.0).alias("q10"), lag.alias("q50"), (lag + 20.0).alias("q90")
    )
    root = scratch_path(spark, "stream-waiting")
    forecasts.write.parquet(f"{root}/forecasts")
    heard = hours.where(~F.col("hour_local").isin(*SILENT)).select("zone", "hour_start", "price_sek_kwh")
    heard.write.parquet(f"{root}/actuals")
    judged = jobs.score_or_wait(
        jobs.landing(spark, f"{root}/forecasts", "zone string, hour_start timestamp_ntz, q10 double, q50 double, q90 double"),
        jobs.landing(spark, f"{root}/actuals", "zone string, hour_start timestamp_ntz, price_sek_kwh double"),
    )
    jobs.append_available(judged, f"{root}/judged", f"{root}/state")
    return spark.read.parquet(f"{root}/judged").select("zone", "hour_start", "status", *six("actual", "error", "inside"))


STREAM_WAITING = with_ctes(
    INTERVALS,
    HOURLY,
    f"""forecasts as (
        select h.zone, h.hour_start, h.hour_local, l.price_sek_kwh as q50, h.price_sek_kwh as price,
               h.hour_local in {SILENT} as silent
        from hourly as h join hourly as l
          on l.zone = h.zone and l.delivery_date = h.delivery_date - 1 and l.hour_local = h.hour_local),
    ends as (
        select least((select max(hour_start) from forecasts),
                     (select max(hour_start) from hourly where hour_local not in {SILENT})) - interval 3 days as passed)""",
    select=f"""
    select zone, hour_start, case when silent then 'waiting' else 'scored' end as status,
           case when not silent then {R6('price')} end as actual, case when not silent then {R6('abs(q50 - price)')} end as error,
           case when not silent then {R6('cast(price between q50 - 20 and q50 + 20 as double)')} end as inside
    from forecasts, ends where not silent or hour_start <= passed""",
)


def stream_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly table as it reads after each of three landings: prices, a correction, and a stale repetition beside a second one."""
    root = scratch_path(spark, "stream-corrections")
    quarters = (
        driver_table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("zone"), minutes_floor("ts", 15).alias("interval_start"))
        .agg(F.max("value").alias("price_sek_kwh"))
    )
    quarters = materialise(quarters, "quarters")
    at = F.minute("interval_start")
    version = lambda rows, n, factor: rows.withColumns(
        {"price_sek_kwh": F.col("price_sek_kwh") * factor, "published": F.lit(n)}
    )
    landings = (
        version(quarters, 1, 1.0),
        version(quarters.where(at == 0), 2, 2.0),
        version(quarters.where(at == 0), 1, 9.0).unionByName(version(quarters.where(at == 30), 2, 3.0)),
    )
    write, shown = jobs.merge_hours(f"{root}/intervals", f"{root}/hours"), []
    for number, part in enumerate(landings, 1):
        part.write.mode("append").parquet(f"{root}/landing")
        landed = jobs.landing(
            spark, f"{root}/landing", "zone string, interval_start timestamp_ntz, price_sek_kwh double, published int"
        )
        jobs.each_batch_available(jobs.changed_intervals(landed), write, f"{root}/state", mode="update")
        shown.append(materialise(spark.read.parquet(f"{root}/hours").withColumn("landing", F.lit(number)), "shown"))
    return reduce(DataFrame.unionByName, shown).select(
        "landing", "zone", "delivery_date", "hour_start", "n_intervals",
        *six("price_sek_kwh", "min_interval_price", "max_interval_price"),
    )


STREAM_CORRECTIONS = f"""
    with quarters as (
        select event_type as zone, time_bucket(interval 15 minutes, ts) as start, max(value) as price
        from events group by all),
    shown as (
        select landing, zone, start,
               price * case when start <= (select max(start) - interval 3 days from quarters) then 1
                            when extract('minute' from start) = 0 and landing >= 2 then 2
                            when extract('minute' from start) = 30 and landing = 3 then 3 else 1 end as price
        from quarters, (select unnest([1, 2, 3]) as landing))
    select landing, zone, cast({LOCAL('start')} as date) as delivery_date, date_trunc('hour', start) as hour_start,
           count(*) as n_intervals, {R6('avg(price)')} as price_sek_kwh, {R6('min(price)')} as min_interval_price,
           {R6('max(price)')} as max_interval_price
    from shown group by all"""

HALFWAY = "2024-01-15 00:00:00"


def stream_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of every (type, user): the files of two half months arrive one after the other."""
    events = driver_table(spark, sf_dir, "events").select("event_type", "user_id", "ts", "event_id", "value")
    root = scratch_path(spark, "stream-first")
    early = F.col("ts") < F.lit(HALFWAY).cast("timestamp_ntz")
    write = jobs.keep_first(f"{root}/kept", "ts", "event_type", "user_id")
    schema = "event_type string, user_id bigint, ts timestamp_ntz, event_id bigint, value double"
    for part in (events.where(early), events.where(~early)):
        part.write.mode("append").parquet(f"{root}/landing")
        jobs.each_batch_available(
            jobs.landing(spark, f"{root}/landing", schema), write, f"{root}/state"
        )
    return spark.read.parquet(f"{root}/kept").select(
        "event_type", "user_id", "ts", "event_id", rounded("value").alias("value")
    )


STREAM_DEDUP_FIRST = f"""
    select event_type, user_id, ts, event_id, {R6('value')} as value from (
      select *, row_number() over (partition by event_type, user_id order by ts, event_id) as n from events)
    where n = 1"""


def stream_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw day documents validated as they land; the day status table is the result."""
    root = scratch_path(spark, "stream-validate")
    ingest_queries.raw_price_days(spark, sf_dir).write.parquet(f"{root}/landing")
    days = jobs.landing(spark, f"{root}/landing", "zone string, day date, value string", 4).select(
        "zone",
        "day",
        F.concat_ws("/", "zone", F.col("day").cast("string")).alias("source"),
        F.from_json("value", PRICE_PAYLOAD).alias("payload"),
    )
    write = jobs.validate_batches(f"{root}/prices", f"{root}/status")
    jobs.each_batch_available(days, write, f"{root}/state")
    # The days of every month's first week land again, without a record.
    again = ingest_queries.raw_price_days(spark, sf_dir).where(F.dayofmonth("day") <= 7)
    again.withColumn("value", F.lit("[]")).write.mode("append").parquet(f"{root}/landing")
    jobs.each_batch_available(days, write, f"{root}/state")
    kinds = "interval_start timestamp_ntz, zone string, delivery_date date"
    prices = spark.read.schema(kinds).parquet(f"{root}/prices")
    valid = (
        jobs.current_prices(prices, spark.read.parquet(f"{root}/status"))
        .groupBy("zone", F.col("delivery_date").alias("day"))
        .agg(F.count("*").alias("intervals"))
    )
    return (
        spark.read.parquet(f"{root}/status")
        .join(valid, ["zone", "day"], "left")
        .select("zone", "day", "source", "reason", F.coalesce("intervals", F.lit(0)).alias("intervals"))
    )


STREAM_VALIDATE = ingest_queries.DAY_VALIDATION.replace(
    "select zone, day, records, cast(resolution_minutes as bigint) as resolution_minutes, reason from judged",
    "select zone, day, zone || '/' || day as source, case when day(day) <= 7 then 'empty payload' else reason end as reason,"
    " case when reason is null and day(day) > 7 then records else 0 end as intervals from judged",
)

QUERIES = {
    "stream_hourly": (stream_hourly, STREAM_HOURLY),
    "stream_score": (stream_score, STREAM_SCORE),
    "stream_waiting": (stream_waiting, STREAM_WAITING),
    "stream_corrections": (stream_corrections, STREAM_CORRECTIONS),
    "stream_dedup_first": (stream_dedup_first, STREAM_DEDUP_FIRST),
    "stream_validate": (stream_validate, STREAM_VALIDATE),
}
