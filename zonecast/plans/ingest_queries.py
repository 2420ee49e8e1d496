"""Queries over ingest planning, raw-day validation and nested weather payloads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.clock import iso_local, local_date, minutes_floor, month_start
from zonecast.operators import ingest, validate
from zonecast.plans import panels
from zonecast.plans.shape import big, six
from zonecast.plans.sqltext import LOCAL, R6, UTC, with_ctes
from zonecast.sources.raw import POINTS_PAYLOAD, PRICE_PAYLOAD, month_of, price_patterns
from zonecast.sources.tables import driver_table

# Days of the all-types zone that are edited so that every rule has a day to reject.
GAP, TWICE, HIGH, NULL, LATE, NO_KEY, EMPTY, SHORT, ALONE = (date(2024, 1, d) for d in range(5, 14))


def raw_price_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly event prices as landed JSON text, one document per (zone, day).

    Zones are the event types and all of them together; a document has at most 25 records.
    """
    hours = (
        driver_table(spark, sf_dir, "events")
        .withColumn("start", minutes_floor("ts", 60))
        .groupingSets([["event_type", "start"], ["start"]], "event_type", "start")
        .agg((panels.exact_mean("value") - panels.PRICE_SHIFT).alias("price"))
    )
    text = lambda c: c.cast("string")
    record = F.create_map(
        F.lit("SEK_per_kWh"), text(F.col("price")),
        F.lit("EUR_per_kWh"), text(F.col("price") / panels.EUR_RATE),
        F.lit("EXR"), text(F.lit(panels.EUR_RATE)),
        F.lit("time_start"), iso_local("start"),
    )
    days = (
        hours.withColumn("record", record)
        .groupBy(
            F.coalesce("event_type", F.lit("all")).alias("zone"), local_date("start").alias("day")
        )
        .agg(F.collect_list(F.struct("start", "record")).alias("r"))
        .withColumn("r", F.transform(F.array_sort("r", _by_start), lambda x: x["record"]))
    )
    return days.select(
        "zone",
        "day",
        F.to_json(_edited(F.col("r")), {"ignoreNullFields": "false"}).alias("value"),
    )


def _by_start(a: Column, b: Column) -> Column:
    """Maps have no order, so the structs around them are compared by start alone."""
    return F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)


def _edited(r: Column) -> Column:
    third = lambda edit: F.transform(r, lambda x, i: F.when(i == 2, edit(x)).otherwise(x))

    def with_price(x: Column, price: Column) -> Column:
        return F.map_concat(
            F.map_filter(x, lambda k, _: k != "SEK_per_kWh"), F.create_map(F.lit("SEK_per_kWh"), price)
        )

    edits = {
        GAP: F.filter(r, lambda _, i: i != 5),
        TWICE: F.concat(r, F.slice(r, -1, 1)),
        HIGH: third(lambda x: with_price(x, F.lit("250.0"))),
        NULL: third(lambda x: with_price(x, F.lit(None).cast("string"))),
        LATE: F.filter(r, lambda _, i: i > 0),
        NO_KEY: third(lambda x: F.map_filter(x, lambda k, _: k != "SEK_per_kWh")),
        EMPTY: F.filter(r, lambda _: F.lit(False)),
        SHORT: F.slice(r, F.lit(1), F.size(r) - 1),
        ALONE: F.slice(r, 1, 1),
    }
    day = F.when(F.col("zone") != "all", r)
    for when, edit in edits.items():
        day = day.when(F.col("day") == F.lit(when), edit)
    return day.otherwise(r)


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = raw_price_days(spark, sf_dir).select(
        "zone",
        "day",
        F.concat_ws("/", "zone", F.col("day").cast("string")).alias("source"),
        F.from_json("value", PRICE_PAYLOAD).alias("payload"),
    )
    return validate.check_price_days(documents)


def day_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select(
        "zone",
        "day",
        F.size("records").cast("bigint").alias("records"),
        *big("resolution_minutes"),
        "reason",
    )


_RAW = f"""raw as (
    select zone, cast({LOCAL('start')} as date) as day, start, price from (
      select event_type as zone, date_trunc('hour', ts) as start,
             cast(sum(cast(value as decimal(18,2))) as double) / count(*) - 20.0 as price
      from events group by all
      union all
      select 'all', date_trunc('hour', ts), cast(sum(cast(value as decimal(18,2))) as double) / count(*) - 20.0
      from events group by all)),
placed as (
    select *, zone = 'all' as edit, row_number() over (partition by zone, day order by start) as pos,
           row_number() over (partition by zone, day order by start desc) as from_end from raw),
landed as (
    select zone, day, start, edit and day = date '{NO_KEY}' and pos = 3 as broken,
           case when edit and day = date '{HIGH}' and pos = 3 then 250.0
                when edit and day = date '{NULL}' and pos = 3 then null else price end as price
    from placed
    where not (edit and ((day = date '{GAP}' and pos = 6) or (day = date '{LATE}' and pos = 1)
               or (day = date '{SHORT}' and from_end = 1) or (day = date '{ALONE}' and pos > 1)
               or day = date '{EMPTY}'))
    union all
    select zone, day, start, false, price from placed where edit and day = date '{TWICE}' and from_end = 1),
gaps as (
    select *, date_diff('second', lag(start) over (partition by zone, day order by start), start) / 60.0 as gap
    from landed),
modes as (
    select zone, day, cast(gap as integer) as resolution,
           row_number() over (partition by zone, day order by count(*) desc, gap) as place
    from gaps where gap is not null group by zone, day, gap),
facts as (
    select zone, day, count(*) as records, count(distinct start) as starts, min(start) as first_start,
           bool_or(broken) as broken, bool_or(price is null) as priceless, bool_or(abs(price) > 100) as wild
    from landed group by all),
uneven as (
    select g.zone, g.day, bool_or(gap <> resolution) as uneven
    from gaps as g join modes as m on m.zone = g.zone and m.day = g.day and place = 1
    where gap is not null group by all),
judged as (
    select d.zone, d.day, coalesce(records, 0) as records, coalesce(resolution, 0) as resolution_minutes,
           case when records is null then 'empty payload'
                when broken then 'malformed record: missing SEK_per_kWh'
                when starts < records then 'duplicate interval starts'
                when coalesce(resolution, 0) not in (15, 60) then 'interval length ' || coalesce(resolution, 0) || ' min'
                when {LOCAL('first_start')} <> cast(d.day as timestamp)
                  then 'day starts at ' || strftime({LOCAL('first_start')}, '%Y-%m-%dT%H:%M:%S') || '+01:00'
                when uneven then 'gap or overlap between intervals'
                when records <> date_diff('minute', {UTC('cast(d.day as timestamp)')}, {UTC('cast(d.day + 1 as timestamp)')}) // resolution
                  then records || ' intervals, expected ' || date_diff('minute', {UTC('cast(d.day as timestamp)')}, {UTC('cast(d.day + 1 as timestamp)')}) // resolution
                when priceless then 'missing price'
                when wild then 'price outside +/-100.0 SEK/kWh' end as reason
    from (select distinct zone, day from raw) as d
    left join facts as f on f.zone = d.zone and f.day = d.day
    left join modes as m on m.zone = d.zone and m.day = d.day and place = 1
    left join uneven as u on u.zone = d.zone and u.day = d.day)"""

DAY_VALIDATION = with_ctes(
    _RAW,
    select="""
    select zone, day, records, cast(resolution_minutes as bigint) as resolution_minutes, reason from judged""",
)


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.quarantined(validate.day_status(_checked(spark, sf_dir)))


QUARANTINE_REASONS = with_ctes(
    _RAW,
    select="select zone, day, zone || '/' || day as source, reason from judged where reason is not null",
)


def build_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.build_stats(_checked(spark, sf_dir))


BUILD_STATS = with_ctes(
    _RAW,
    select="""
    select count(distinct (zone, date_trunc('month', day))) filter (where reason is null) as months_built,
           count(*) filter (where reason is null) as days_ok,
           count(*) filter (where reason is not null) as days_quarantined
    from judged""",
)


def parsed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = validate.valid_intervals(_checked(spark, sf_dir))
    return rows.select(
        "zone",
        "delivery_date",
        "interval_start",
        "interval_end",
        *big("resolution_minutes"),
        *six("price_sek_kwh", "price_eur_kwh", "eur_sek_rate"),
    )


PARSED_RECORDS = with_ctes(
    _RAW,
    select=f"""
    select l.zone, l.day as delivery_date, start as interval_start,
           start + to_minutes(j.resolution_minutes) as interval_end,
           cast(j.resolution_minutes as bigint) as resolution_minutes, {R6('price')} as price_sek_kwh,
           {R6('price / 11.2')} as price_eur_kwh, {R6('cast(11.2 as double)')} as eur_sek_rate
    from landed as l join judged as j on j.zone = l.zone and j.day = l.day
    where reason is null""",
)

# Months whose payload is edited: one loses a point, one loses a variable.
FEW_POINTS, NO_VARIABLE = "1996-02", "1996-03"
SHIP_POINTS = ((0, "A", "returned"), (1, "N", "none"), (2, "R", "refused"))


def ship_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SHIP_POINTS, "position int, point string, zone string")


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily shipment measures as nested JSON: one document per month, one point per flag.

    A point holds parallel arrays of at most 31 days. Measures of a month's 13th are not numbers.
    """
    daily = (
        driver_table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", F.col("l_shipdate").cast("date").alias("day"))
        .agg(
            (panels.exact_mean("l_discount") * 100).alias("a"),
            panels.exact_mean("l_quantity").alias("b"),
            F.count("*").alias("c"),
            F.max("l_quantity").alias("d"),
        )
    )
    text = lambda c: F.col(c).cast("string").alias(c)
    rows = daily.select(
        "l_returnflag",
        "day",
        F.when(F.dayofmonth("day") == 13, "n/a").otherwise(F.col("a").cast("string")).alias("a"),
        text("b"), text("c"), text("d"),
    )
    lists = rows.groupBy("l_returnflag", month_of("day").alias("name")).agg(
        F.sort_array(F.collect_list(F.struct("day", "a", "b", "c", "d"))).alias("h")
    )
    series = lambda f: F.transform("h", lambda x: x[f])
    hourly = F.create_map(
        F.lit("time"), F.transform("h", lambda x: F.date_format(x["day"], "yyyy-MM-dd'T'00:00")),
        F.lit("temperature_2m"), series("a"), F.lit("wind_speed_100m"), series("b"),
        F.lit("shortwave_radiation"), series("c"), F.lit("cloud_cover"), series("d"),
    )
    cut = (F.col("name") == NO_VARIABLE) & (F.col("l_returnflag") == "A")
    points = lists.withColumn(
        "hourly", F.when(cut, F.map_filter(hourly, lambda k, _: k != "cloud_cover")).otherwise(hourly)
    )
    docs = points.groupBy("name").agg(
        F.sort_array(F.collect_list(F.struct("l_returnflag", F.to_json(F.struct("hourly")).alias("j")))).alias("p")
    )
    listed = F.concat(F.lit("["), F.array_join(F.transform("p", lambda x: x["j"]), ","), F.lit("]"))
    fewer = F.concat(F.lit("["), F.array_join(F.transform(F.slice("p", 1, 2), lambda x: x["j"]), ","), F.lit("]"))
    return docs.select("name", F.when(F.col("name") == FEW_POINTS, fewer).otherwise(listed).alias("value"))


def _weather_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = weather_documents(spark, sf_dir).select(
        "name", F.from_json("value", POINTS_PAYLOAD).alias("payload")
    )
    return validate.check_weather(docs, ship_registry(spark), len(SHIP_POINTS), "name")


def nested_points_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = validate.flatten_weather(_weather_checked(spark, sf_dir), ship_registry(spark), "name")
    return rows.select("name", "point", "zone", "valid_at", *six(*panels.WEATHER))


_SHIP_DAYS = """points as (
    select l_returnflag as point, cast(l_shipdate as date) as day, strftime(l_shipdate, '%Y-%m') as name,
           cast(sum(cast(l_discount as decimal(18,2))) as double) / count(*) * 100 as a,
           cast(sum(cast(l_quantity as decimal(18,2))) as double) / count(*) as b,
           cast(count(*) as double) as c, max(l_quantity) as d
    from lineitem group by all),
judged as (
    select name, case when n <> 3 then n || ' weather points, expected 3'
                      when name = '1996-03' then 'A: missing [''cloud_cover'']' end as reason
    from (select name, case when name = '1996-02' then least(n, 2) else n end as n
          from (select name, count(distinct point) as n from points group by name)))"""

NESTED_POINTS_FLATTEN = with_ctes(
    _SHIP_DAYS,
    select=f"""
    select name, point, case point when 'A' then 'returned' when 'N' then 'none' else 'refused' end as zone,
           cast(day as timestamp) as valid_at,
           {R6('case when day(day) = 13 then null else a end')} as temperature_2m, {R6('b')} as wind_speed_100m,
           {R6('c')} as shortwave_radiation, {R6('d')} as cloud_cover
    from points join judged using (name) where reason is null""",
)


def weather_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weather_checked(spark, sf_dir).where(F.col("reason").isNotNull()).select("name", "reason")


WEATHER_QUARANTINE = with_ctes(
    _SHIP_DAYS, select="select name, reason from judged where reason is not null"
)


def missing_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone-days to fetch when a day counts as landed once it has events in at least 20 hours."""
    hours = panels.stored_hourly(spark, sf_dir)
    landed = (
        hours.groupBy("zone", F.col("delivery_date").alias("day"))
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= 20)
    )
    bounds = hours.agg(F.min("delivery_date").alias("first"), F.max("delivery_date").alias("last"))
    return ingest.price_worklist(
        panels.zones_of(hours),
        landed,
        start=bounds.select("first").scalar(),
        today=bounds.select("last").scalar(),
    )


MISSING_WORKLIST = f"""
    with hours as (
      select distinct event_type as zone, cast({LOCAL("date_trunc('hour', ts)")} as date) as day,
             date_trunc('hour', ts) as h from events),
    bounds as (select min(day) as a, max(day) as b from hours)
    select zone, day from (select distinct zone from hours),
         (select cast(unnest(generate_series(cast(a as timestamp), cast(b + 1 as timestamp), interval 1 day)) as date) as day from bounds)
    where day >= (select b - 2 from bounds)
       or (zone, day) not in (select (zone, day) from hours group by zone, day having count(*) >= 20)"""


def month_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months to fetch when a month counts as landed once every day of it has an order."""
    day = F.col("o_orderdate").cast("date")
    orders = driver_table(spark, sf_dir, "orders")
    landed = (
        orders.groupBy(month_start(day).alias("month"))
        .agg(F.count_distinct(day).alias("days"))
        .where(F.col("days") == F.dayofmonth(F.last_day("month")))
    )
    bounds = orders.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ingest.month_worklist(bounds, landed, "first", "last")


MONTH_WORKLIST = """
    with days as (select distinct cast(o_orderdate as date) as d from orders)
    select month, least(last_day(month), last) as month_end
    from (select unnest(generate_series(cast(date_trunc('month', a) as timestamp), cast(b as timestamp), interval 1 month))::date as month, b as last
          from (select min(d) as a, max(d) as b from days))
    where month >= date_trunc('month', last) - interval 1 month
       or month not in (select cast(date_trunc('month', d) as date) from days group by 1
                        having count(*) = max(day(last_day(d))))"""


def stale_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority-months with an order newer than the newest finished one, or with none finished."""
    orders = driver_table(spark, sf_dir, "orders")
    zone, day = F.col("o_orderpriority").alias("zone"), F.col("o_orderdate").cast("date").alias("day")
    files = orders.select(zone, day, F.col("o_orderdate").alias("modified"))
    built = (
        orders.where(F.col("o_orderstatus") == "F")
        .groupBy(zone, month_of("o_orderdate").alias("month"))
        .agg(F.max("o_orderdate").alias("built_at"))
    )
    return ingest.stale_groups(files, built)


STALE_GROUPS = """
    select * exclude (built_at) from (
      select o_orderpriority as zone, strftime(o_orderdate, '%Y-%m') as month, count(*) as files,
             max(o_orderdate) as newest_file, max(o_orderdate) filter (where o_orderstatus = 'F') as built_at
      from orders group by all)
    where built_at is null or newest_file > built_at"""



def stale_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stale groups as what a build would read: one path pattern a zone and year."""
    patterns = price_patterns(stale_groups(spark, sf_dir))
    return patterns.select("pattern", *big("groups"))


STALE_PATTERNS = f"""
    select zone || '/*/' || left(month, 4) || '-{{' || string_agg(right(month, 2), ',' order by month) || '}}-*.json' as pattern,
           count(*) as groups
    from ({STALE_GROUPS}) group by zone, left(month, 4)"""

QUERIES = {
    "missing_worklist": (missing_worklist, MISSING_WORKLIST),
    "month_worklist": (month_worklist, MONTH_WORKLIST),
    "stale_groups": (stale_groups, STALE_GROUPS),
    "stale_patterns": (stale_patterns, STALE_PATTERNS),
    "day_validation": (day_validation, DAY_VALIDATION),
    "quarantine_reasons": (quarantine_reasons, QUARANTINE_REASONS),
    "build_stats": (build_stats, BUILD_STATS),
    "parsed_records": (parsed_records, PARSED_RECORDS),
    "nested_points_flatten": (nested_points_flatten, NESTED_POINTS_FLATTEN),
    "weather_quarantine": (weather_quarantine, WEATHER_QUARANTINE),
}
