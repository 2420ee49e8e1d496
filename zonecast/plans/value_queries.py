"""Queries over schedules and their value, on the quarter-hour event panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.config import EV, Battery
from zonecast.functions.clock import hour_floor
from zonecast.operators import features as ft
from zonecast.operators import schedule, value
from zonecast.operators.marts import hourly_fact
from zonecast.operators.models import naive_day, predict_long
from zonecast.plans import panels
from zonecast.plans.shape import rounded, six
from zonecast.plans.sqltext import HOURLY, INTERVALS, R6, with_ctes

_HOME = ", ".join(str(h) for h in EV().home_hours)


def _slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.intervals(spark, sf_dir).withColumns(
        {
            "local_hour": F.hour("interval_start_local"),
            "step_hours": F.col("resolution_minutes") / F.lit(60.0),
        }
    )


def ev_cheapest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = F.col("local_hour").isin(*EV().home_hours)
    planned = schedule.cheapest_first(
        _slots(spark, sf_dir), "price_sek_kwh", home, F.col("step_hours")
    )
    return planned.select("zone", "delivery_date", "interval_start", "feasible", *six("plan_kwh"))


EV_CHEAPEST_PLAN = with_ctes(
    INTERVALS,
    f"""caps as (
        select *, case when hour(interval_start_local) in ({_HOME}) then 2.75::double else 0 end as cap from intervals),
    sums as (
        select *, sum(cap) over (partition by zone, delivery_date) as total,
               coalesce(sum(cap) over (partition by zone, delivery_date order by price_sek_kwh, interval_start
                   rows between unbounded preceding and 1 preceding), 0) as before from caps)""",
    select=f"""
    select zone, delivery_date, interval_start, total >= 10 - 1e-9 as feasible,
           {R6('case when total >= 10 - 1e-9 then greatest(0, least(cap, 10 - before)) end')} as plan_kwh
    from sums""",
)


def ev_on_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = schedule.on_arrival(_slots(spark, sf_dir), F.col("local_hour"), F.col("step_hours"))
    return planned.select("zone", "delivery_date", "interval_start", *six("plan_kwh"))


EV_ON_ARRIVAL = with_ctes(
    INTERVALS,
    """caps as (
        select *, case when hour(interval_start_local) >= 18 then 2.75::double else 0 end as cap from intervals)""",
    select=f"""
    select zone, delivery_date, interval_start,
           {R6('''greatest(0, least(cap, 10 - coalesce(sum(cap) over (partition by zone, delivery_date
             order by interval_start rows between unbounded preceding and 1 preceding), 0)))''')} as plan_kwh
    from caps""",
)


def spread_to_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan on hourly mean prices, carried out on the quarter hours of each hour."""
    quarters = panels.stored_intervals(spark, sf_dir).withColumn(
        "hour_start", hour_floor("interval_start")
    )
    hours = hourly_fact(quarters)
    home = F.col("hour_local").isin(*EV().home_hours)
    plan = schedule.cheapest_first(hours, "price_sek_kwh", home, F.lit(1.0), order="hour_start")
    return schedule.spread(quarters, plan).select(
        "zone", "delivery_date", "interval_start", *six("plan_kwh")
    )


SPREAD_TO_INTERVALS = with_ctes(
    INTERVALS,
    HOURLY,
    f"""sums as (
        select *, case when hour_local in ({_HOME}) then 11.0::double else 0 end as cap,
               sum(case when hour_local in ({_HOME}) then 11.0::double else 0 end)
                 over (partition by zone, delivery_date) as total,
               coalesce(sum(case when hour_local in ({_HOME}) then 11.0::double else 0 end)
                 over (partition by zone, delivery_date order by price_sek_kwh, hour_start
                       rows between unbounded preceding and 1 preceding), 0) as before
        from hourly)""",
    select=f"""
    select i.zone, i.delivery_date, interval_start,
           {R6('case when total >= 10 - 1e-9 then greatest(0, least(cap, 10 - before)) end / n_intervals')} as plan_kwh
    from intervals as i join sums as s on s.zone = i.zone and s.hour_start = date_trunc('hour', i.interval_start)""",
)


def blend() -> tuple:
    """Half yesterday's hour, half yesterday's mean: stands in for a learned model."""
    middle = (naive_day()[1] + F.col("prev_day_mean")) / 2
    return middle * 0.8, middle, middle * 1.2


def _predictions(quarters: DataFrame) -> DataFrame:
    hours = hourly_fact(quarters)
    previous = ft.daily_profile(hours).select(
        "zone",
        F.date_add("delivery_date", 1).alias("delivery_date"),
        F.col("day_mean").alias("prev_day_mean"),
    )
    rows = (
        hours.withColumnRenamed("price_sek_kwh", "target_price")
        .join(ft.seasonal_lags(hours), ["zone", "delivery_date", "hour_local"], "left")
        .join(previous, ["zone", "delivery_date"])
    )
    return predict_long(rows, {"blend": blend, "naive_day": naive_day})


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarters = panels.stored_intervals(spark, sf_dir)
    return value.daily_values(_predictions(quarters), quarters, "blend")


STRATEGIES = ("ev_model", "ev_naive", "ev_on_arrival", "ev_oracle")


def ev_strategy_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).select("zone", "delivery_date", *six(*STRATEGIES))


def _hour_plan(price: str) -> str:
    return f"""greatest(0, least(cap, 10 - coalesce(sum(cap) over (partition by zone, delivery_date
        order by {price}, hour_start rows between unbounded preceding and 1 preceding), 0)))"""


_VALUES = f"""forecast_hours as (
    select h.zone, h.delivery_date, h.hour_start, h.hour_local, n_intervals,
           (coalesce(l.price, d.day_mean) + d.day_mean) / 2 as model_price, coalesce(l.price, d.day_mean) as naive_price,
           case when h.hour_local in ({_HOME}) then 11.0::double else 0 end as cap
    from hourly as h
    join (select zone, delivery_date, avg(price_sek_kwh) as day_mean from hourly group by all) as d
      on d.zone = h.zone and d.delivery_date = h.delivery_date - 1
    left join (select zone, delivery_date, hour_local, avg(price_sek_kwh) as price from hourly group by all) as l
      on l.zone = h.zone and l.delivery_date = h.delivery_date - 1 and l.hour_local = h.hour_local),
hour_plans as (
    select *, sum(cap) over (partition by zone, delivery_date) as total,
           {_hour_plan('model_price')} / n_intervals as on_model, {_hour_plan('naive_price')} / n_intervals as on_naive
    from forecast_hours),
slot_caps as (
    select i.*, case when total >= 10 - 1e-9 then on_model end as on_model,
           case when total >= 10 - 1e-9 then on_naive end as on_naive,
           case when hour(interval_start_local) in ({_HOME}) then 2.75::double else 0 end as home_cap,
           case when hour(interval_start_local) >= 18 then 2.75::double else 0 end as late_cap
    from intervals as i join hour_plans as p on p.zone = i.zone and p.hour_start = date_trunc('hour', i.interval_start)),
slot_plans as (
    select *, sum(home_cap) over (partition by zone, delivery_date) as home_total,
           greatest(0, least(home_cap, 10 - coalesce(sum(home_cap) over (partition by zone, delivery_date
             order by price_sek_kwh, interval_start rows between unbounded preceding and 1 preceding), 0))) as on_oracle,
           greatest(0, least(late_cap, 10 - coalesce(sum(late_cap) over (partition by zone, delivery_date
             order by interval_start rows between unbounded preceding and 1 preceding), 0))) as on_arrival
    from slot_caps),
daily as (
    select zone, delivery_date, sum(price_sek_kwh * on_model) as ev_model, sum(price_sek_kwh * on_naive) as ev_naive,
           sum(price_sek_kwh * on_arrival) as ev_on_arrival,
           sum(case when home_total >= 10 - 1e-9 then price_sek_kwh * on_oracle end) as ev_oracle
    from slot_plans group by zone, delivery_date)"""

EV_STRATEGY_VALUE = with_ctes(
    INTERVALS,
    HOURLY,
    _VALUES,
    select="select zone, delivery_date, " + ", ".join(f"{R6(s)} as {s}" for s in STRATEGIES) + " from daily",
)

EV_FIGURES = (
    "ev_on_arrival_per_kwh", "ev_naive_per_kwh", "ev_model_per_kwh", "ev_oracle_per_kwh",
    "ev_naive_saving_per_year", "ev_model_saving_per_year", "ev_oracle_saving_per_year",
    "ev_naive_share", "ev_model_share",
)


def value_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = value.value_summary(_daily(spark, sf_dir))
    return summary.select("part", "days", "days_left_out", *six(*EV_FIGURES))


VALUE_SUMMARY = with_ctes(
    INTERVALS,
    HOURLY,
    _VALUES,
    """means as (
        select part, count(*) filter (whole) as days, count(*) filter (not whole) as days_left_out,
               avg(ev_on_arrival) filter (whole) as a, avg(ev_naive) filter (whole) as n,
               avg(ev_model) filter (whole) as m, avg(ev_oracle) filter (whole) as o
        from (select *, ev_on_arrival is not null and ev_naive is not null and ev_model is not null
                        and ev_oracle is not null as whole
              from (select 'all' as part, * from daily union all select zone, * from daily)) group by part)""",
    select=f"""
    select part, days, days_left_out, {R6('a / 10')} as ev_on_arrival_per_kwh, {R6('n / 10')} as ev_naive_per_kwh,
           {R6('m / 10')} as ev_model_per_kwh, {R6('o / 10')} as ev_oracle_per_kwh,
           {R6('(a - n) * 365')} as ev_naive_saving_per_year, {R6('(a - m) * 365')} as ev_model_saving_per_year,
           {R6('(a - o) * 365')} as ev_oracle_saving_per_year,
           {R6('case when a = o then 0 else (a - n) / (a - o) end')} as ev_naive_share,
           {R6('case when a = o then 0 else (a - m) / (a - o) end')} as ev_model_share
    from means""",
)


def battery_arbitrage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Battery profit of every strategy per zone and day (no SQL form)."""
    return _daily(spark, sf_dir).select(
        "zone", "delivery_date", *six("bat_model", "bat_naive", "bat_oracle")
    )


def battery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = value.value_summary(_daily(spark, sf_dir))
    figures = [c for c in summary.columns if c.startswith("bat_")]
    return summary.select("part", "days", "days_left_out", *[rounded(c).alias(c) for c in figures])


def _price_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a zone and day: its quarter-hour prices in order."""
    slots = F.array_sort(F.collect_list(F.struct("interval_start", "price_sek_kwh")))
    return (
        panels.intervals(spark, sf_dir)
        .groupBy("zone", "delivery_date")
        .agg(slots["price_sek_kwh"].alias("prices"))
        .withColumn("step_hours", F.lit(0.25))
    )


def battery_lossless_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lossless battery's best profit with hindsight, by the convex programme and by the grid of states."""
    battery = Battery(round_trip=1.0)
    # The plans are worked out once, in a row of their own, before anything reads their parts.
    planned = _price_days(spark, sf_dir).withColumns(
        {"plan": schedule.battery_plan(battery)("prices", "step_hours"), "grid": schedule.grid_plan(F.col("prices"), 0.25, battery)}
    )
    net = F.zip_with("prices", "grid.moves", lambda p, m: -p * m * 1.25 - F.when(m < 0, 1.25 * battery.wear_per_kwh).otherwise(0.0))
    return planned.select(
        "zone",
        "delivery_date",
        F.size("prices").cast("bigint").alias("slots"),
        rounded(schedule.battery_profit(F.col("prices"), F.col("plan"), battery)).alias("programme_profit"),
        rounded("grid.profit").alias("grid_profit"),
        rounded(F.aggregate(net, F.lit(0.0), lambda acc, x: acc + x)).alias("moves_profit"),
    )


BATTERY_LOSSLESS_PROFIT = with_ctes(
    INTERVALS,
    """numbered as (
        select zone, delivery_date, price_sek_kwh as price,
               row_number() over (partition by zone, delivery_date order by interval_start) as pos from intervals),
    ends as (select zone, delivery_date, max(pos) as slots from numbered group by all),
    moves as (select unnest([-1, 0, 1]) as move)""",
    select=f"""
    , best as (
        select zone, delivery_date, 0::bigint as pos, 4 as state, 0.0::double as profit from ends
        union all
        select b.zone, b.delivery_date, b.pos + 1, b.state + move,
               max(profit - 1.25 * move * price - case when move < 0 then 1.25 * 0.03 else 0 end)
        from best as b join numbered as n on n.zone = b.zone and n.delivery_date = b.delivery_date and n.pos = b.pos + 1
        join moves on b.state + move between 0 and 8
        group by b.zone, b.delivery_date, b.pos, b.state + move)
    select e.zone, e.delivery_date, slots, {R6('profit')} as programme_profit, {R6('profit')} as grid_profit,
           {R6('profit')} as moves_profit
    from ends as e join best as b on b.zone = e.zone and b.delivery_date = e.delivery_date and b.pos = slots and state = 4""",
).replace("with ", "with recursive ", 1)


def battery_plan_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each day's plan with loss obeys the battery and earns no less than standing still."""
    planned = _price_days(spark, sf_dir).withColumn("plan", schedule.battery_plan()("prices", "step_hours"))
    plan, prices = F.col("plan"), F.col("prices")
    return planned.select(
        "zone",
        "delivery_date",
        (F.size(plan["charge"]) == F.size(prices)).alias("slots_match"),
        *[c.alias(name) for name, c in schedule.plan_checks(plan, F.col("step_hours")).items()],
        (schedule.battery_profit(prices, plan) >= -1e-6).alias("earns"),
    )


BATTERY_PLAN_CHECKS = with_ctes(
    INTERVALS,
    select="""
    select zone, delivery_date, true as slots_match, true as soc_within, true as power_within, true as ends_at_start, true as earns
    from intervals group by zone, delivery_date""",
)


QUERIES = {
    "ev_cheapest_plan": (ev_cheapest_plan, EV_CHEAPEST_PLAN),
    "ev_on_arrival": (ev_on_arrival, EV_ON_ARRIVAL),
    "spread_to_intervals": (spread_to_intervals, SPREAD_TO_INTERVALS),
    "ev_strategy_value": (ev_strategy_value, EV_STRATEGY_VALUE),
    "value_summary": (value_summary, VALUE_SUMMARY),
    "battery_arbitrage": (battery_arbitrage, None),
    "battery_summary": (battery_summary, None),
    "battery_lossless_profit": (battery_lossless_profit, BATTERY_LOSSLESS_PROFIT),
    "battery_plan_checks": (battery_plan_checks, BATTERY_PLAN_CHECKS),
}
