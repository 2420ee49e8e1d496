"""Queries over the calendar, the marts and the data-quality operators, with their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.clock import day_minutes, expected_intervals, hour_floor, local_date, minutes_floor, plus_minutes
from zonecast.operators import features as ft
from zonecast.operators import quality
from zonecast.operators.marts import daily_zone_stats, hourly_fact, interval_fact
from zonecast.plans import panels
from zonecast.plans.shape import big, six
from zonecast.plans.sqltext import HOLIDAYS, INTERVALS, LOCAL, R6, UTC, with_ctes
from zonecast.session import materialise, scratch_path
from zonecast.sources.generators import calendar, date_series
from zonecast.sources.tables import driver_table, read_seed


def hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = hourly_fact(panels.intervals(spark, sf_dir))
    return fact.select(
        "zone",
        "delivery_date",
        "hour_start",
        *big("hour_local", "n_intervals"),
        *six("price_sek_kwh", "min_interval_price", "max_interval_price"),
    )


HOURLY_ROLLUP = with_ctes(
    INTERVALS,
    select=f"""
    select zone, delivery_date, date_trunc('hour', interval_start) as hour_start,
           cast(hour({LOCAL("date_trunc('hour', interval_start)")}) as bigint) as hour_local,
           count(*) as n_intervals,
           {R6('avg(price_sek_kwh)')} as price_sek_kwh,
           {R6('min(price_sek_kwh)')} as min_interval_price,
           {R6('max(price_sek_kwh)')} as max_interval_price
    from intervals group by all""",
)


def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarters = panels.stored_intervals(spark, sf_dir)
    stats = daily_zone_stats(quarters, panels.calendar_of(quarters))
    return stats.select(
        "delivery_date",
        "zone",
        *big("resolution_minutes", "negative_intervals"),
        *six("mean_price", "min_price", "max_price", "intraday_spread"),
        "cheapest_interval_local",
        "dearest_interval_local",
        "is_workday",
    )


DAILY_STATS = with_ctes(
    INTERVALS,
    HOLIDAYS("select distinct year(delivery_date) as y from intervals"),
    select=f"""
    select p.delivery_date, p.zone,
           cast(any_value(resolution_minutes) as bigint) as resolution_minutes,
           count(*) filter (where price_sek_kwh < 0) as negative_intervals,
           {R6('avg(price_sek_kwh)')} as mean_price, {R6('min(price_sek_kwh)')} as min_price,
           {R6('max(price_sek_kwh)')} as max_price,
           {R6('max(price_sek_kwh) - min(price_sek_kwh)')} as intraday_spread,
           min(interval_start_local) filter (where price_sek_kwh = lo) as cheapest_interval_local,
           min(interval_start_local) filter (where price_sek_kwh = hi) as dearest_interval_local,
           isodow(p.delivery_date) < 6
             and p.delivery_date not in (select holiday_date from holidays) as is_workday
    from (select *, min(price_sek_kwh) over (partition by zone, delivery_date) as lo,
                 max(price_sek_kwh) over (partition by zone, delivery_date) as hi
          from intervals) as p
    group by p.delivery_date, p.zone""",
)


def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the span of the orders, with the orders of each day."""
    orders = materialise(_order_days(spark, sf_dir), "order-counts")
    return (
        panels.calendar_of(orders.withColumnRenamed("date_day", "delivery_date"))
        .join(orders, "date_day", "left")
        .select(
            "date_day",
            *big("year", "month", "iso_dow"),
            "is_weekend",
            "is_holiday",
            "holiday_name",
            "is_workday",
            F.coalesce("orders", F.lit(0)).alias("orders"),
        )
    )


CALENDAR_DIM = with_ctes(
    """days as (
        select cast(d as date) as date_day from (
          select unnest(generate_series(min(o_orderdate), max(o_orderdate) + interval 7 days,
                                        interval 1 day)) as d from orders))""",
    HOLIDAYS("select distinct year(date_day) as y from days"),
    select="""
    select date_day, year(date_day) as year, month(date_day) as month, isodow(date_day) as iso_dow,
           isodow(date_day) >= 6 as is_weekend, holiday_date is not null as is_holiday, holiday_name,
           isodow(date_day) < 6 and holiday_date is null as is_workday,
           coalesce(n, 0) as orders
    from days left join holidays on holiday_date = date_day
    left join (select cast(o_orderdate as date) as d, count(*) as n from orders group by all) on d = date_day""",
)


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        driver_table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date_day"))
        .agg(F.count("*").alias("orders"))
    )


def dst_day_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_days(spark, sf_dir).select(
        "date_day",
        "orders",
        day_minutes("date_day").cast("bigint").alias("day_minutes"),
        expected_intervals("date_day", 60).cast("bigint").alias("hours"),
        expected_intervals("date_day", 15).cast("bigint").alias("quarters"),
    )


_DAY_MINUTES = (
    f"date_diff('minute', {UTC('cast(date_day as timestamp)')}, {UTC('cast(date_day + 1 as timestamp)')})"
)
DST_DAY_LENGTHS = f"""
    select date_day, orders, m as day_minutes, m // 60 as hours, m // 15 as quarters from (
      select date_day, orders, {_DAY_MINUTES} as m
      from (select cast(o_orderdate as date) as date_day, count(*) as orders from orders group by all))"""


def local_hours_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The real hours of every local day that has orders: 23, 24 or 25 of 26 candidates."""
    from zonecast.functions.clock import day_start_utc, local_date, local_hour, plus_hours

    candidates = _order_days(spark, sf_dir).select(
        "date_day", F.explode(F.sequence(F.lit(0), F.lit(25))).alias("k")
    )
    return (
        candidates.withColumn("hour_start", plus_hours(day_start_utc("date_day"), F.col("k")))
        .where(local_date("hour_start") == F.col("date_day"))
        .select("date_day", "hour_start", local_hour("hour_start").cast("bigint").alias("hour_local"))
    )


LOCAL_HOURS_OF_DAY = f"""
    select date_day, hour_start, cast(hour({LOCAL('hour_start')}) as bigint) as hour_local from (
      select date_day, {UTC('cast(date_day as timestamp)')} + to_hours(k) as hour_start
      from (select distinct cast(o_orderdate as date) as date_day from orders),
           (select unnest(range(0, 26)) as k))
    where cast({LOCAL('hour_start')} as date) = date_day"""


def complete_days_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.incomplete_days(panels.intervals(spark, sf_dir, minutes=60)).select(
        "zone", "delivery_date", *big("resolution_minutes", "intervals", "day_minutes")
    )


COMPLETE_DAYS_CHECK = with_ctes(
    INTERVALS.replace("15", "60"),
    select=f"""
    select * from (
      select zone, date_day as delivery_date, resolution_minutes, intervals, {_DAY_MINUTES} as day_minutes
      from (select zone, delivery_date as date_day, cast(any_value(resolution_minutes) as bigint) as resolution_minutes,
                   count(*) as intervals from intervals group by all))
    where intervals * resolution_minutes <> day_minutes""",
)


def coverage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of priced days (orders) that have a covariate (shipments on that day)."""
    facts = panels.daily_panel(spark, sf_dir)
    ships = driver_table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("delivery_date")
    )
    result = quality.coverage(facts, ships, "delivery_date")
    return result.select(*big("hours", "with_weather"), *six("coverage"))


COVERAGE_CHECK = f"""
    select count(*) as hours, count(s.d) as with_weather,
           {R6('count(s.d) / count(*)')} as coverage
    from (select distinct o_orderpriority as zone, cast(o_orderdate as date) as d from orders) as p
    left join (select distinct cast(l_shipdate as date) as d from lineitem) as s on s.d = p.d"""


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours without the same hour of yesterday, a missing value by construction of the data."""
    hours = panels.stored_hourly(spark, sf_dir)
    lagged = hours.join(ft.seasonal_lags(hours), ["zone", "delivery_date", "hour_local"], "left")
    return quality.not_null(lagged, "lag_1d", F.col("hour_local") != 2).select(
        "zone", "delivery_date", "hour_start", *big("hour_local")
    )


DQ_NOT_NULL = with_ctes(
    INTERVALS,
    f"""hourly as (
        select zone, delivery_date, date_trunc('hour', interval_start) as hour_start,
               hour({LOCAL("date_trunc('hour', interval_start)")}) as hour_local
        from intervals group by all)""",
    select="""
    select zone, delivery_date, hour_start, cast(hour_local as bigint) as hour_local from hourly as t
    where hour_local <> 2 and not exists (
      select 1 from hourly as s where s.zone = t.zone and s.delivery_date = t.delivery_date - 1
                                  and s.hour_local = t.hour_local)""",
)


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines that share (order, line number)."""
    return quality.unique_combination(
        driver_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber"
    ).select("l_orderkey", *big("l_linenumber", "n"))


DQ_UNIQUE = """
    select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, count(*) as n
    from lineitem group by all having count(*) > 1"""


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders that were never seen in the events, with how many orders they have."""
    return quality.relationships(
        driver_table(spark, sf_dir, "orders"), "o_custkey", driver_table(spark, sf_dir, "events"), "user_id"
    )


DQ_RELATIONSHIPS = """
    select o_custkey, count(*) as n from orders
    where o_custkey is not null and o_custkey not in (select user_id from events where user_id is not null) group by all"""


def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that are not made of one or four intervals."""
    return quality.accepted_values(panels.hourly(spark, sf_dir), "n_intervals", 1, 4)


DQ_ACCEPTED = with_ctes(
    INTERVALS,
    select="""
    select n_intervals, count(*) as n from (
      select zone, date_trunc('hour', interval_start), count(*) as n_intervals from intervals group by all)
    where n_intervals not in (1, 4) group by all""",
)


SEED_SCHEMA = "n_nationkey bigint, zone string, n_regionkey bigint"


def _nation_seed(spark: SparkSession, sf_dir: str) -> str:
    """The nations as a CSV seed: some keys are no numbers, some lines are cut short, one nation is there twice."""
    key = F.col("n_nationkey")
    fields = [F.when(key % 5 == 2, F.lit("n/a")).otherwise(key.cast("string")), F.col("n_name"), F.col("n_regionkey").cast("string")]
    line = F.when(key % 7 == 3, F.concat_ws(",", *fields[:2])).otherwise(F.concat_ws(",", *fields))
    lines = F.array(F.struct(F.lit(1).alias("place"), line.alias("value")))
    twice = F.when(key == 4, F.concat(lines, lines)).otherwise(lines)
    # 25 rows at any size of the other tables, and one file, as its first line is the header.
    rows = driver_table(spark, sf_dir, "nation").select(F.inline(twice), "n_nationkey")
    header = spark.range(1).select(F.lit(0).alias("place"), F.lit("n_nationkey,zone,n_regionkey").alias("value"), F.lit(-1).alias("n_nationkey"))
    path = scratch_path(spark, "seed")
    header.unionByName(rows).coalesce(1).sortWithinPartitions("place", "n_nationkey").select("value").write.text(path)
    return path


def seed_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared CSV read back: its rows, and the lines that do not fit with the reason."""
    rows, rejects = read_seed(spark, _nation_seed(spark, sf_dir), SEED_SCHEMA, "zone")
    return rows.unionByName(rejects, allowMissingColumns=True)


_SEED = """seed as (
    select n_nationkey, n_name as zone, n_regionkey, n_nationkey % 5 = 2 as lettered, n_nationkey % 7 = 3 as short from nation
    union all select n_nationkey, n_name, n_regionkey, false, false from nation where n_nationkey = 4),
zones as (select distinct zone from seed where not lettered and not short)"""
SEED_WITH_REJECTS = with_ctes(
    _SEED,
    select="""
    select distinct cast(n_nationkey as bigint) as n_nationkey, zone, cast(n_regionkey as bigint) as n_regionkey,
           cast(null as varchar) as line, cast(null as varchar) as reason
    from seed where not lettered and not short
    union all
    select null, null, null,
           case when lettered then 'n/a' else cast(n_nationkey as varchar) end || ',' || zone
             || case when short then '' else ',' || n_regionkey end, 'does not fit the declared columns'
    from seed where lettered or short
    union all
    select null, null, null, '4,' || n_name || ',' || n_regionkey, 'repeats zone' from nation where n_nationkey = 4""",
)

# The days that the suite's calendar declares, whatever the panel holds.
FIRST_DAY, LAST_DAY = date(2024, 1, 1), date(2024, 1, 29)


def _nation_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as market intervals of their user's nation; counted by user first, so that a busy one is a row a quarter hour."""
    users = (
        driver_table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("c_custkey"), minutes_floor("ts", 15).alias("interval_start"))
        .agg(F.sum(F.rint(F.col("value") * 100).cast("bigint")).alias("hundredths"), F.count("*").alias("n"))
    )
    nations = driver_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("zone"))
    customers = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    price = F.sum("hundredths").cast("double") / 100.0 / F.sum("n") - panels.PRICE_SHIFT
    rows = users.join(customers, "c_custkey").join(nations, "c_nationkey").groupBy("zone", "interval_start").agg(price.alias("price_sek_kwh"))
    return interval_fact(
        rows.select(
            "zone",
            local_date("interval_start").alias("delivery_date"),
            "interval_start",
            plus_minutes("interval_start", 15).alias("interval_end"),
            F.lit(15).alias("resolution_minutes"),
            "price_sek_kwh",
            (F.col("price_sek_kwh") / panels.EUR_RATE).alias("price_eur_kwh"),
            F.lit(panels.EUR_RATE).alias("eur_sek_rate"),
        )
    )


def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 22 tests of a build over the panel of nations: (test, failures).

    Zones come from the seed, which lacks the nations whose lines are rejected, and the calendar from its declared days; the weather covers the hours
    in which someone bought or clicked.
    """
    intervals = materialise(_nation_intervals(spark, sf_dir), "nation-intervals")
    hours = materialise(hourly_fact(intervals), "nation-hours")
    zones, _ = read_seed(spark, _nation_seed(spark, sf_dir), SEED_SCHEMA, "zone")
    days = calendar(date_series(spark, FIRST_DAY, LAST_DAY))
    seen = driver_table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "click"))
    weather = (
        seen.select(F.col("user_id").alias("c_custkey"), hour_floor("ts").alias("valid_at"))
        .distinct()
        .join(driver_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey")
        .join(driver_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("zone")), "n_nationkey")
        .select("zone", "valid_at")
        .distinct()
    )
    profile = ft.daily_profile(hours).select(
        "zone", F.date_add("delivery_date", 1).alias("delivery_date"), F.col("day_mean").alias("prev_day_mean")
    )
    features = (
        hours.join(ft.seasonal_lags(hours), ["zone", "delivery_date", "hour_local"], "left")
        .join(profile, ["zone", "delivery_date"], "left")
        .withColumn("issue_date", F.date_sub("delivery_date", 1))
    )
    stats = daily_zone_stats(intervals, panels.calendar_of(intervals))
    return quality.warehouse_tests(zones, days, intervals, hours, weather, stats, features)


_NATION = INTERVALS.replace("event_type as zone", "n_name as zone").replace(
    "from events group by all", "from events join customer on c_custkey = user_id join nation on n_nationkey = c_nationkey group by all"
)
_LAG = """select 1 from hours as t where hour_local <> 2 and not exists (
    select 1 from hours as s where s.zone = t.zone and s.delivery_date = t.delivery_date - {days} and s.hour_local = t.hour_local)"""
_VIOLATIONS = {
    "unique_dim_zone_zone": "select 1 from zones group by zone having count(*) > 1",
    "not_null_dim_zone_zone": "select 1 from zones where zone is null",
    "unique_dim_date_date_day": "select 1 from days group by date_day having count(*) > 1",
    "not_null_dim_date_date_day": "select 1 from days where date_day is null",
    "unique_fct_price_interval": "select 1 from intervals group by zone, interval_start having count(*) > 1",
    "not_null_fct_price_interval_zone": "select 1 from intervals where zone is null",
    "not_null_fct_price_interval_delivery_date": "select 1 from intervals where delivery_date is null",
    "not_null_fct_price_interval_price_sek_kwh": "select 1 from intervals where price_sek_kwh is null",
    "accepted_fct_price_interval_resolution": "select 1 from intervals where resolution_minutes not in (15, 60)",
    "relationships_fct_price_interval_zone": "select 1 from intervals where zone not in (select zone from zones)",
    "relationships_fct_price_interval_delivery_date":
        "select 1 from intervals where delivery_date not in (select date_day from days)",
    "unique_fct_price_hourly": "select 1 from hours group by zone, hour_start having count(*) > 1",
    "accepted_fct_price_hourly_n_intervals": "select 1 from hours where n not in (1, 4)",
    "unique_fct_weather_hourly": "select 1 from weather group by zone, valid_at having count(*) > 1",
    "unique_mart_daily_zone_stats": """select 1 from (select zone, delivery_date from intervals group by all)
        group by zone, delivery_date having count(*) > 1""",
    "unique_feat_price_hourly": "select 1 from hours group by zone, hour_start having count(*) > 1",
    "not_null_feat_lag_1d": _LAG.format(days=1),
    "not_null_feat_lag_7d": _LAG.format(days=7),
    "not_null_feat_prev_day_mean": """select 1 from hours as t where not exists (
        select 1 from hours as s where s.zone = t.zone and s.delivery_date = t.delivery_date - 1)""",
    "not_null_feat_issue_date": "select 1 from hours where delivery_date is null",
    "complete_delivery_days": f"""select 1 from (
        select zone, delivery_date as date_day, count(*) * 15 as filled from intervals group by all)
        where filled <> {_DAY_MINUTES}""",
    "weather_covers_prices": """select 1 from (
        select count(*) as n, count(w.zone) as found from hours as h
        left join weather as w on w.zone = h.zone and w.valid_at = h.hour_start) where found < 0.99 * n""",
}
DQ_RESULTS = with_ctes(
    _NATION,
    f"""hours as (
        select zone, delivery_date, date_trunc('hour', interval_start) as hour_start,
               hour({LOCAL("date_trunc('hour', interval_start)")}) as hour_local, count(*) as n from intervals group by all)""",
    _SEED,
    """weather as (
        select n_name as zone, date_trunc('hour', ts) as valid_at from events join customer on c_custkey = user_id
        join nation on n_nationkey = c_nationkey where event_type in ('purchase', 'click') group by all)""",
    f"""days as (
        select cast(unnest(generate_series(timestamp '{FIRST_DAY}', timestamp '{LAST_DAY}', interval 1 day)) as date) as date_day)""",
    select=" union all ".join(
        f"select '{name}' as test, count(*) as failures from ({rows})" for name, rows in _VIOLATIONS.items()
    ),
)


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.suite_summary(dq_results(spark, sf_dir))


DQ_SUMMARY = f"select count(*) filter (where failures = 0) as passed, count(*) as total from ({DQ_RESULTS})"

QUERIES = {
    "hourly_rollup": (hourly_rollup, HOURLY_ROLLUP),
    "daily_zone_stats": (daily_stats, DAILY_STATS),
    "calendar_dim": (calendar_dim, CALENDAR_DIM),
    "dst_day_lengths": (dst_day_lengths, DST_DAY_LENGTHS),
    "local_hours_of_day": (local_hours_of_day, LOCAL_HOURS_OF_DAY),
    "complete_days_check": (complete_days_check, COMPLETE_DAYS_CHECK),
    "coverage_check": (coverage_check, COVERAGE_CHECK),
    "dq_not_null": (dq_not_null, DQ_NOT_NULL),
    "dq_unique": (dq_unique, DQ_UNIQUE),
    "dq_relationships": (dq_relationships, DQ_RELATIONSHIPS),
    "dq_accepted": (dq_accepted, DQ_ACCEPTED),
    "dq_results": (dq_results, DQ_RESULTS),
    "seed_with_rejects": (seed_with_rejects, SEED_WITH_REJECTS),
    "dq_summary": (dq_summary, DQ_SUMMARY),
}
