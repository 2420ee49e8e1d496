"""What a forecast is worth: strategies planned on forecasts, costed at the cleared prices."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import EV, MARKET_TZ, Battery
from zonecast.functions.clock import hour_floor, local_hour
from zonecast.functions.numeric import share
from zonecast.operators.schedule import (
    DAY_KEYS,
    battery_plan,
    battery_profit,
    cheapest_first,
    hourly_on_intervals,
    on_arrival,
)

HOUR_KEYS = ("zone", "delivery_date", "hour_start")


def wide_forecasts(predictions: DataFrame, model: str, baseline: str = "naive_day") -> DataFrame:
    """One row per hour with both models' medians (mean if a model repeats an hour)."""
    return (
        predictions.where(F.col("model").isin(model, baseline))
        .groupBy(*HOUR_KEYS)
        .agg(
            F.avg(F.when(F.col("model") == model, F.col("q50"))).alias("model_price"),
            F.avg(F.when(F.col("model") == baseline, F.col("q50"))).alias("naive_price"),
        )
    )


def matched_slots(forecasts: DataFrame, intervals: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """Market intervals with the forecast of their hour, for days whose hour sets agree.

    A full outer join leaves a hole on one side for every hour the other side lacks; a day with
    a hole is dropped whole, never padded.
    """
    market = intervals.select(
        "zone",
        "delivery_date",
        hour_floor("interval_start").alias("hour_start"),
        "interval_start",
        "resolution_minutes",
        "price_sek_kwh",
    )
    hole = (
        F.col("interval_start").isNull()
        | F.col("model_price").isNull()
        | F.col("naive_price").isNull()
    )
    day = Window.partitionBy(*DAY_KEYS)
    return (
        market.join(forecasts, list(HOUR_KEYS), "full_outer")
        .withColumn("_holes", F.count_if(hole).over(day))
        .where(F.col("_holes") == 0)
        .drop("_holes")
        .withColumns(
            {
                "in_hour": F.count("*").over(Window.partitionBy(*HOUR_KEYS)),
                "local_hour": local_hour("interval_start", tz),
                "step_hours": F.min("resolution_minutes").over(day) / F.lit(60.0),
            }
        )
    )


def daily_values(
    predictions: DataFrame,
    intervals: DataFrame,
    model: str,
    baseline: str = "naive_day",
    ev: EV = EV(),
    battery: Battery = Battery(),
    tz: str = MARKET_TZ,
) -> DataFrame:
    """One row per zone and day: EV cost and battery profit of every strategy.

    One exchange brings forecasts and intervals of an hour together and one more brings the day
    together; all plans, costs and arrays then share that partitioning.
    """
    slots = matched_slots(wide_forecasts(predictions, model, baseline), intervals, tz)
    home = F.col("local_hour").isin(*ev.home_hours)
    for forecast, name in (("model_price", "_ev_model"), ("naive_price", "_ev_naive")):
        slots = hourly_on_intervals(slots, forecast, home, "in_hour", ev, name)
    slots = on_arrival(slots, F.col("local_hour"), F.col("step_hours"), ev=ev, name="_ev_on_arrival")
    slots = cheapest_first(
        slots, "price_sek_kwh", home, F.col("step_hours"), ev=ev, name="_ev_oracle"
    )
    strategies = ("ev_model", "ev_naive", "ev_on_arrival", "ev_oracle")
    days = slots.groupBy(*DAY_KEYS).agg(
        *[F.sum(F.col("price_sek_kwh") * F.col(f"_{s}")).alias(s) for s in strategies],
        F.min("step_hours").alias("step_hours"),
        F.array_sort(
            F.collect_list(
                F.struct(
                    "interval_start", "hour_start", "price_sek_kwh", "model_price", "naive_price"
                )
            )
        ).alias("slots"),
    )
    return _with_battery(days, battery).select(
        *DAY_KEYS, *strategies, "bat_model", "bat_naive", "bat_oracle"
    )


def _with_battery(days: DataFrame, battery: Battery) -> DataFrame:
    """Battery profits from the day's sorted slots.

    An hourly plan is spread evenly over its hour, so it earns the hour's mean price.
    """
    first_of_hour = F.filter(
        F.col("slots"),
        lambda x, i: (i == 0) | (F.get(F.col("slots"), i - 1)["hour_start"] != x["hour_start"]),
    )
    hours = F.transform(
        F.col("hours"),
        lambda h: F.transform(
            F.filter("slots", lambda x: x["hour_start"] == h["hour_start"]),
            lambda x: x["price_sek_kwh"],
        ),
    )
    mean = F.transform(
        hours, lambda p: F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x) / F.size(p)
    )
    arrays = days.withColumn("hours", first_of_hour).select(
        "*",
        mean.alias("hour_prices"),
        F.transform("hours", lambda h: h["model_price"]).alias("model_prices"),
        F.transform("hours", lambda h: h["naive_price"]).alias("naive_prices"),
        F.transform("slots", lambda x: x["price_sek_kwh"]).alias("prices"),
    )
    plan = battery_plan(battery)
    planned = arrays.select(
        "*",
        plan("model_prices", F.lit(1.0)).alias("plan_model"),
        plan("naive_prices", F.lit(1.0)).alias("plan_naive"),
        plan("prices", "step_hours").alias("plan_oracle"),
    )
    return planned.withColumns(
        {
            "bat_model": battery_profit(F.col("hour_prices"), F.col("plan_model"), battery),
            "bat_naive": battery_profit(F.col("hour_prices"), F.col("plan_naive"), battery),
            "bat_oracle": battery_profit(F.col("prices"), F.col("plan_oracle"), battery),
        }
    )


def value_summary(daily: DataFrame, ev: EV = EV()) -> DataFrame:
    """Yearly figures and shares of the hindsight result, overall and by zone, in one pass.

    Only days count on which every strategy has a value, that is, the car gets its full energy;
    ``days_left_out`` counts the others.
    """
    strategies = (
        "ev_on_arrival", "ev_naive", "ev_model", "ev_oracle", "bat_naive", "bat_model", "bat_oracle",
    )
    complete = reduce(and_, (F.col(s).isNotNull() for s in strategies))
    means = (
        daily.groupingSets([[], ["zone"]], "zone")
        .agg(
            F.count_if(complete).alias("days"),
            F.count_if(~complete).alias("days_left_out"),
            F.grouping("zone").alias("whole"),
            *[F.avg(F.when(complete, F.col(s))).alias(s) for s in strategies],
        )
        .withColumn("part", F.when(F.col("whole") == 1, F.lit("all")).otherwise(F.col("zone")))
    )
    c = F.col
    saved = lambda k: c("ev_on_arrival") - c(f"ev_{k}")
    out = [c(f"ev_{k}") / ev.energy_kwh for k in ("on_arrival", "naive", "model", "oracle")]
    names = [f"ev_{k}_per_kwh" for k in ("on_arrival", "naive", "model", "oracle")]
    for k in ("naive", "model", "oracle"):
        out.append(saved(k) * 365)
        names.append(f"ev_{k}_saving_per_year")
    for k in ("naive", "model"):
        out.append(share(saved(k), saved("oracle")))
        names.append(f"ev_{k}_share")
    for k in ("naive", "model", "oracle"):
        out.append(c(f"bat_{k}") * 365)
        names.append(f"bat_{k}_profit_per_year")
    for k in ("naive", "model"):
        out.append(share(c(f"bat_{k}"), c("bat_oracle")))
        names.append(f"bat_{k}_share")
    return means.select("part", "days", "days_left_out", *[x.alias(n) for x, n in zip(out, names, strict=True)])
