"""Queries over the report datasets and the storage rules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.functions.clock import day_start_utc
from zonecast.operators import features as ft
from zonecast.operators import report
from zonecast.operators import score as sc
from zonecast.operators.marts import daily_zone_stats, hourly_fact
from zonecast.operators.models import predict_long
from zonecast.plans import forecast_queries, ingest_queries, marts_queries, panels
from zonecast.plans.shape import big, rounded, six
from zonecast.plans.sqltext import DAILY_PANEL, HOURLY, INTERVALS, LOCAL, R6, UTC, with_ctes
from zonecast.session import materialise, scratch_path
from zonecast.sources.sinks import merge_recent, write_once
from zonecast.sources.tables import driver_table, numbered


def lag_mean() -> tuple:
    """Mean of the lags that exist, else yesterday's mean; bounds 20 % of its size away."""
    lags = [F.col(f"lag_{k}d") for k in (1, 2, 7)]
    total = sum((F.coalesce(x, F.lit(0.0)) for x in lags[1:]), F.coalesce(lags[0], F.lit(0.0)))
    count = sum((x.isNotNull().cast("int") for x in lags[1:]), lags[0].isNotNull().cast("int"))
    middle = F.coalesce(total / F.nullif(count, F.lit(0)), F.col("prev_day_mean"))
    return middle - 0.2 * F.abs(middle), middle, middle + 0.2 * F.abs(middle)


def issued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast of the day after the last priced one, issued at ten local time the day before.

    Stored first, as an issued log is: the report reads it several times and must see one value.
    """
    hours = panels.stored_hourly(spark, sf_dir)
    previous = ft.daily_profile(hours).select(
        "zone",
        F.date_add("delivery_date", 1).alias("delivery_date"),
        F.col("day_mean").alias("prev_day_mean"),
    )
    rows = (
        ft.next_day_hours(hours, panels.zones_of(hours))
        .withColumnRenamed("price_sek_kwh", "target_price")
        .join(ft.seasonal_lags(hours), ["zone", "delivery_date", "hour_local"], "left")
        .join(previous, ["zone", "delivery_date"], "left")
        .withColumn("naive_day", F.coalesce("lag_1d", "prev_day_mean"))
    )
    keep = ("zone", "delivery_date", "hour_start", "hour_local", "naive_day")
    ten = F.timestamp_add("HOUR", F.lit(10), day_start_utc(F.date_sub("delivery_date", 1)))
    log = predict_long(rows, {"lag_mean": lag_mean}, *keep).select(
        *keep,
        "q10",
        "q50",
        "q90",
        ten.alias("issued_at"),
        F.lit("lag-mean-v1").alias("model_version"),
    )
    return materialise(log, "issued")


_ISSUED = f"""last as (select max(delivery_date) as d from hourly),
scaffold as (
    select zone, d + 1 as delivery_date, h as hour_start, hour({LOCAL('h')}) as hour_local, d
    from (select zone, d, {UTC('cast(d + 1 as timestamp)')} + to_hours(k) as h
          from (select distinct zone from hourly), last, (select unnest(range(0, 26)) as k))
    where cast({LOCAL('h')} as date) = d + 1),
lagged as (
    select s.*, l1.price_sek_kwh as a, l2.price_sek_kwh as b, l7.price_sek_kwh as c, m.day_mean
    from scaffold as s
    left join hourly as l1 on l1.zone = s.zone and l1.delivery_date = s.d and l1.hour_local = s.hour_local
    left join hourly as l2 on l2.zone = s.zone and l2.delivery_date = s.d - 1 and l2.hour_local = s.hour_local
    left join hourly as l7 on l7.zone = s.zone and l7.delivery_date = s.d - 6 and l7.hour_local = s.hour_local
    left join (select zone, delivery_date, avg(price_sek_kwh) as day_mean from hourly group by all) as m
      on m.zone = s.zone and m.delivery_date = s.d),
issued as (
    select *, q50 - 0.2::double * abs(q50) as q10, q50 + 0.2::double * abs(q50) as q90,
           {UTC('cast(d as timestamp)')} + interval 10 hours as issued_at, 'lag-mean-v1' as model_version
    from (select zone, delivery_date, hour_start, hour_local, d, coalesce(a, day_mean) as naive,
                 coalesce((coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0))
                          / nullif((a is not null)::int + (b is not null)::int + (c is not null)::int, 0), day_mean) as q50
          from lagged))"""


def tomorrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.tomorrow(issued(spark, sf_dir)).select(
        "delivery_date", "issued_at", "model_version", "zone", "hour_start", *big("hour_local"),
        *six("q10", "q50", "q90", "naive"),
    )


TOMORROW = with_ctes(
    INTERVALS,
    HOURLY,
    _ISSUED,
    select=f"""
    select delivery_date, issued_at, model_version, zone, hour_start, cast(hour_local as bigint) as hour_local,
           {R6('q10')} as q10, {R6('q50')} as q50, {R6('q90')} as q90, {R6('naive')} as naive
    from issued""",
)


def latest_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.latest_actual(panels.stored_intervals(spark, sf_dir)).select(
        "delivery_date", "zone", *big("resolution_minutes"), "interval_start", "start_local", *six("price")
    )


LATEST_ACTUAL = with_ctes(
    INTERVALS,
    select=f"""
    select delivery_date, zone, cast(resolution_minutes as bigint) as resolution_minutes, interval_start,
           interval_start_local as start_local, {R6('price_sek_kwh')} as price
    from intervals where delivery_date = (select max(delivery_date) from intervals)""",
)


def recent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 120 days of the order panel, one interval per day."""
    panel = panels.stored_days(spark, sf_dir).select(
        "zone",
        "delivery_date",
        F.col("hour_start").alias("interval_start_local"),
        (F.col("price_sek_kwh") - 2.5).alias("price_sek_kwh"),
        F.lit(1440).alias("resolution_minutes"),
    )
    stats = daily_zone_stats(panel, panels.calendar_of(panel))
    return report.recent_days(stats).select(
        "delivery_date", "zone", *six("mean_price", "min_price", "max_price", "intraday_spread"),
        *big("negative_intervals"),
    )


RECENT_DAYS = with_ctes(
    DAILY_PANEL,
    select=f"""
    select delivery_date, zone, {R6('price_sek_kwh - 2.5')} as mean_price, {R6('price_sek_kwh - 2.5')} as min_price,
           {R6('price_sek_kwh - 2.5')} as max_price, {R6('0.0::double')} as intraday_spread,
           cast(price_sek_kwh < 2.5 as bigint) as negative_intervals
    from hourly where delivery_date > (select max(delivery_date) from hourly) - 120""",
)


def cheapest_k_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.cheapest_hours(panels.hourly(spark, sf_dir), "price_sek_kwh").select(
        "zone", "delivery_date", "hour_start", *big("place"), *six("price_sek_kwh")
    )


CHEAPEST_K_HOURS = with_ctes(
    INTERVALS,
    HOURLY,
    select=f"""
    select zone, delivery_date, hour_start, place, {R6('price_sek_kwh')} as price_sek_kwh from (
      select *, row_number() over (partition by zone, delivery_date order by price_sek_kwh, hour_start) as place
      from hourly) where place <= 3""",
)


def price_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut points between seven equally filled bins of all quarter-hour prices."""
    cuts = report.price_cuts(panels.stored_intervals(spark, sf_dir), "price_sek_kwh")
    return cuts.select(*big("position"), *six("cut"))


PRICE_BINS = with_ctes(
    INTERVALS,
    select=f"""
    select cast(i - 1 as bigint) as position, {R6('price_sek_kwh')} as cut
    from (select price_sek_kwh, row_number() over (order by price_sek_kwh) - 1 as place, count(*) over () as n from intervals),
         (select unnest(range(1, 7)) as i)
    where place = least(n - 1, cast(floor(i / 7 * n) as bigint))""",
)


def timetable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.timetable(issued(spark, sf_dir)).select(
        "zone", "delivery_date", "hour_start", "label", *six("q50"), *big("bin"), "cheap"
    )


TIMETABLE = with_ctes(
    INTERVALS,
    HOURLY,
    _ISSUED,
    """cuts as (
        select q50 as cut from (select q50, row_number() over (order by q50) - 1 as place, count(*) over () as n from issued where q50 is not null),
          (select unnest(range(1, 7)) as i) where place = least(n - 1, cast(floor(i / 7 * n) as bigint)))""",
    select=f"""
    select zone, delivery_date, hour_start,
           lpad(cast(hour_local as varchar), 2, '0')
             || case when row_number() over (partition by zone, hour_local order by hour_start) > 1 then 'b' else '' end as label,
           {R6('q50')} as q50, (select count(*) from cuts where cut <= q50) as bin,
           q50 is not null and row_number() over (partition by zone order by q50 nulls last, hour_start) <= 3 as cheap
    from issued""",
)


def aligned_day_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.aligned_actual(issued(spark, sf_dir), panels.stored_intervals(spark, sf_dir)).select(
        "zone", "hour_start", *big("hour_local"), *six("q10", "q50", "q90", "day_before")
    )


ALIGNED_DAY_COMPARE = with_ctes(
    INTERVALS,
    HOURLY,
    _ISSUED,
    select=f"""
    select i.zone, i.hour_start, cast(i.hour_local as bigint) as hour_local, {R6('q10')} as q10, {R6('q50')} as q50,
           {R6('q90')} as q90, {R6('h.price_sek_kwh')} as day_before
    from issued as i left join hourly as h
      on h.zone = i.zone and h.delivery_date = i.d and h.hour_start = i.hour_start - interval 1 day""",
)


def zone_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = report.zone_cards(issued(spark, sf_dir), panels.stored_intervals(spark, sf_dir))
    return cards.select("zone", *six("forecast_mean", "actual_mean"))


ZONE_CARDS = with_ctes(
    INTERVALS,
    HOURLY,
    _ISSUED,
    select=f"""
    select zone, {R6('f')} as forecast_mean, {R6('a')} as actual_mean
    from (select zone, avg(q50) as f from issued group by zone)
    left join (select zone, avg(price_sek_kwh) as a from intervals
               where delivery_date = (select max(delivery_date) from intervals) group by zone) using (zone)""",
)


def pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    health = report.pipeline_health(
        panels.stored_intervals(spark, sf_dir),
        ingest_queries.quarantine_reasons(spark, sf_dir),
        marts_queries.dq_results(spark, sf_dir),
    )
    return health.select("first_day", "last_day", *big(*[c for c in health.columns if not c.endswith("_day")]))


PIPELINE_HEALTH = f"""
    select * from (select * from (
      {with_ctes(INTERVALS, select='''select count(distinct delivery_date) as days, count(*) as intervals,
        min(delivery_date) as first_day, max(delivery_date) as last_day, count(distinct zone) as zones from intervals''')})),
      (select count(*) as quarantined_days from ({ingest_queries.QUARANTINE_REASONS})),
      (select count(*) filter (where failures = 0) as tests_passed, count(*) as tests_total from ({marts_queries.DQ_RESULTS}))"""


def model_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models of the order panel, best first in each view, with their error as a share of the largest."""
    scores = sc.score(forecast_queries.predictions(spark, sf_dir))
    place = F.rank().over(Window.partitionBy("scope", "part").orderBy(F.col("mae").asc_nulls_last()))
    return report.share_of_largest(scores, "mae", "scope", "part").select(
        "scope", "part", "model", place.cast("bigint").alias("place"), *six("mae", "share")
    )


MODEL_RANKING = f"""
    select scope, part, model, rank() over (partition by scope, part order by raw) as place, mae,
           {R6('raw / max(raw) over (partition by scope, part)')} as share
    from ({forecast_queries.SKILL_BY_GROUP.replace("s.model, ", "s.model, s.mae as raw, ")})"""

FIRST_RUN = date(2024, 1, 20)


def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly fact built up to a day, then merged with newer days and corrections.

    The first run sees prices ten per cent too high; the second run repairs the newest dates of
    the table and adds the days after them. Older dates keep the first run's prices.
    """
    quarters = panels.stored_intervals(spark, sf_dir)
    path = scratch_path(spark, "hourly-merge")
    first = quarters.where(F.col("delivery_date") <= F.lit(FIRST_RUN)).withColumn(
        "price_sek_kwh", F.col("price_sek_kwh") * 1.1
    )
    for source in (first, quarters):
        merge_recent(spark, path, source, hourly_fact)
    return spark.read.parquet(path).select(
        "zone", "delivery_date", "hour_start", *big("hour_local", "n_intervals"), *six("price_sek_kwh")
    )


INCREMENTAL_MERGE = with_ctes(
    INTERVALS,
    HOURLY,
    select=f"""
    select zone, delivery_date, hour_start, cast(hour_local as bigint) as hour_local, n_intervals,
           {R6(f"case when delivery_date < date '{FIRST_RUN}' - 3 then price_sek_kwh * 1.1 else price_sek_kwh end")} as price_sek_kwh
    from hourly""",
)


def write_once_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order means by day: priced once from finished orders, then offered again from all orders.

    A day written in the first run is never rewritten; days without finished orders are added.
    """
    orders = driver_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "issued")

    def means(rows: DataFrame, run: str) -> DataFrame:
        return rows.groupBy(F.col("o_orderdate").cast("date").alias("delivery_date")).agg(
            (panels.exact_mean("o_totalprice") / panels.ORDER_SCALE).alias("price"),
            F.lit(run).alias("run"),
        )

    for rows, run in ((orders.where(F.col("o_orderstatus") == "F"), "first"), (orders, "second")):
        write_once(means(rows, run), path, "delivery_date")
    return spark.read.parquet(path).select("delivery_date", "run", *six("price"))


WRITE_ONCE_APPEND = f"""
    with days as (
      select cast(o_orderdate as date) as delivery_date,
             cast(sum(cast(o_totalprice as decimal(18,2))) filter (where o_orderstatus = 'F') as double)
               / nullif(count(*) filter (where o_orderstatus = 'F'), 0) / 100000.0 as finished,
             cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) / 100000.0 as everything
      from orders group by all)
    select delivery_date, case when finished is null then 'second' else 'first' end as run,
           {R6('coalesce(finished, everything)')} as price from days"""



def ordered_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quarter hour with its place in the order of zone and time."""
    rows = panels.intervals(spark, sf_dir).select("zone", "interval_start", rounded("price_sek_kwh").alias("price_sek_kwh"))
    return numbered(rows, "zone", "interval_start")


ORDERED_READ = with_ctes(
    INTERVALS,
    select=f"""
    select zone, interval_start, {R6('price_sek_kwh')} as price_sek_kwh,
           row_number() over (order by zone, interval_start) - 1 as position
    from intervals""",
)

QUERIES = {
    "ordered_read": (ordered_read, ORDERED_READ),
    "tomorrow": (tomorrow, TOMORROW),
    "latest_actual": (latest_actual, LATEST_ACTUAL),
    "recent_days": (recent_days, RECENT_DAYS),
    "cheapest_k_hours": (cheapest_k_hours, CHEAPEST_K_HOURS),
    "price_bins": (price_bins, PRICE_BINS),
    "timetable": (timetable, TIMETABLE),
    "aligned_day_compare": (aligned_day_compare, ALIGNED_DAY_COMPARE),
    "zone_cards": (zone_cards, ZONE_CARDS),
    "pipeline_health": (pipeline_health, PIPELINE_HEALTH),
    "model_ranking": (model_ranking, MODEL_RANKING),
    "incremental_merge": (incremental_merge, INCREMENTAL_MERGE),
    "write_once_append": (write_once_append, WRITE_ONCE_APPEND),
}
