"""Charging and storage schedules per zone and day.

A (zone, day) group has at most 100 slots, so its windows and arrays are small however many
zones and days there are. EV plans are window expressions; the battery plan is an exact dynamic
programme over the convex value function of the state of charge, vectorised over Arrow batches
of days.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import EV, Battery

DAY_KEYS = ("zone", "delivery_date")


def fill_in_order(capacity: Column, need: float, before: Column) -> Column:
    """What a slot takes of ``need`` when ``before`` has been offered by the slots ahead of it."""
    return F.greatest(F.lit(0.0), F.least(capacity, F.lit(need) - before))


def cheapest_first(
    slots: DataFrame,
    price: str,
    at_home: Column,
    step_hours: Column,
    order: str = "interval_start",
    ev: EV = EV(),
    name: str = "plan_kwh",
) -> DataFrame:
    """Energy per slot that fills the cheapest available slots first.

    Exactly the needed energy is bought, at negative prices too. Days without enough charging
    time have ``feasible`` false and no plan.
    """
    day = Window.partitionBy(*DAY_KEYS)
    ahead = day.orderBy(price, order).rowsBetween(Window.unboundedPreceding, -1)
    capacity = F.when(at_home, F.lit(ev.power_kw) * step_hours).otherwise(F.lit(0.0))
    return (
        slots.withColumn("_capacity", capacity)
        .withColumn("feasible", F.sum("_capacity").over(day) >= ev.energy_kwh - 1e-9)
        .withColumn("_before", F.coalesce(F.sum("_capacity").over(ahead), F.lit(0.0)))
        .withColumn(
            name,
            F.when(
                F.col("feasible"), fill_in_order(F.col("_capacity"), ev.energy_kwh, F.col("_before"))
            ),
        )
        .drop("_capacity", "_before")
    )


def on_arrival(
    slots: DataFrame,
    local_hour: Column,
    step_hours: Column,
    order: str = "interval_start",
    ev: EV = EV(),
    name: str = "plan_kwh",
) -> DataFrame:
    """Plug in at the arrival hour and charge at full power until full, or until midnight."""
    ahead = (
        Window.partitionBy(*DAY_KEYS).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    capacity = F.when(local_hour >= ev.arrival_hour, F.lit(ev.power_kw) * step_hours).otherwise(
        F.lit(0.0)
    )
    return (
        slots.withColumn("_capacity", capacity)
        .withColumn("_before", F.coalesce(F.sum("_capacity").over(ahead), F.lit(0.0)))
        .withColumn(name, fill_in_order(F.col("_capacity"), ev.energy_kwh, F.col("_before")))
        .drop("_capacity", "_before")
    )


def spread(intervals: DataFrame, hour_plan: DataFrame, plan: str = "plan_kwh") -> DataFrame:
    """An hourly plan carried out on the hour's intervals, in equal parts."""
    keys = ["zone", "delivery_date", "hour_start"]
    in_hour = F.count("*").over(Window.partitionBy(*keys))
    return (
        intervals.withColumn("_n", in_hour)
        .join(hour_plan.select(*keys, plan), keys)
        .withColumn(plan, F.col(plan) / F.col("_n"))
        .drop("_n")
    )


def hourly_on_intervals(
    slots: DataFrame, forecast: str, at_home: Column, in_hour: str, ev: EV = EV(), name: str = "plan_kwh"
) -> DataFrame:
    """cheapest_first on hourly forecasts and spread, in one window over the intervals.

    An interval holds its share of the hour's capacity. The frame is a RANGE, so the intervals of
    one hour (equal forecast and hour) are peers and the running sum counts whole hours.
    """
    day = Window.partitionBy(*DAY_KEYS)
    whole = F.when(at_home, F.lit(ev.power_kw)).otherwise(F.lit(0.0))
    return (
        slots.withColumn("_whole", whole)
        .withColumn("_share", F.col("_whole") / F.col(in_hour))
        .withColumn("_through", F.sum("_share").over(day.orderBy(forecast, "hour_start")))
        .withColumn(
            name,
            F.when(
                F.sum("_share").over(day) >= ev.energy_kwh - 1e-9,
                fill_in_order(F.col("_whole"), ev.energy_kwh, F.col("_through") - F.col("_whole"))
                / F.col(in_hour),
            ),
        )
        .drop("_whole", "_share", "_through")
    )


# Days handled at once; bounds the memory of the value functions of one block.
_BLOCK = 512


def battery_plans(
    prices: list[np.ndarray], step_hours: np.ndarray, battery: Battery = Battery()
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Profit-maximal charge and discharge per slot for many days at once.

    The least cost of reaching a state of charge is convex and piecewise linear: segments kept
    sorted by slope over an interval that starts at ``left``. A slot adds two segments (charge
    more; discharge less), the sorted merge of which is the next value function, and the ends are
    cut to the capacity. Walking back from the required final state, the part of the path that
    lies on a slot's own segments is what the slot does.
    """
    days, slots = len(prices), max((len(p) for p in prices), default=0)
    eta = np.sqrt(battery.round_trip)
    price, used = np.zeros((days, slots)), np.zeros((days, slots), dtype=bool)
    for i, p in enumerate(prices):
        price[i, : len(p)], used[i, : len(p)] = p, True
    limit = np.where(used, (battery.power_kw * step_hours)[:, None], 0.0)
    slope_c, length_c = price / eta, limit * eta
    slope_d, length_d = (price - battery.wear_per_kwh) * eta, limit / eta

    left = np.full(days, float(battery.start_soc_kwh))
    slopes, lengths = np.empty((days, 0)), np.empty((days, 0))
    lefts = np.empty((days, slots))
    below_c, below_d = np.empty((days, slots)), np.empty((days, slots))
    for t in range(slots):
        c, d = slope_c[:, t : t + 1], slope_d[:, t : t + 1]
        lefts[:, t] = left
        below_c[:, t] = np.where(slopes < c, lengths, 0.0).sum(axis=1)
        below_d[:, t] = np.where(slopes < d, lengths, 0.0).sum(axis=1)
        slopes = np.hstack([slopes, c, d])
        lengths = np.hstack([lengths, length_c[:, t : t + 1], length_d[:, t : t + 1]])
        order = np.argsort(slopes, axis=1, kind="stable")
        slopes = np.take_along_axis(slopes, order, axis=1)
        lengths = np.take_along_axis(lengths, order, axis=1)
        left = left - length_d[:, t]
        cut = np.maximum(-left, 0.0)[:, None]
        lengths = np.clip(np.cumsum(lengths, axis=1) - cut, 0.0, lengths)
        left = np.maximum(left, 0.0)
        room = (battery.capacity_kwh - left)[:, None]
        lengths = np.clip(room - (np.cumsum(lengths, axis=1) - lengths), 0.0, lengths)

    charge, discharge = np.zeros((days, slots)), np.zeros((days, slots))
    soc = np.full(days, float(battery.start_soc_kwh))
    for t in range(slots - 1, -1, -1):
        lc, ld = length_c[:, t], length_d[:, t]
        path = soc - lefts[:, t] + ld
        d_first = slope_d[:, t] < slope_c[:, t]
        on_c = np.clip(path - below_c[:, t] - np.where(d_first, ld, 0.0), 0.0, lc)
        on_d = np.clip(path - below_d[:, t] - np.where(d_first, 0.0, lc), 0.0, ld)
        charge[:, t] = on_c / eta
        discharge[:, t] = np.maximum(limit[:, t] - on_d * eta, 0.0)
        soc = soc - on_c - on_d + ld
    sizes = [len(p) for p in prices]
    return (
        [charge[i, :n] for i, n in enumerate(sizes)],
        [discharge[i, :n] for i, n in enumerate(sizes)],
    )


def battery_plan(battery: Battery = Battery()):
    """Column function (prices array, step hours) -> struct<charge, discharge>."""

    # Scalar form, so that several plans of one row share a single pass through Python.
    @F.pandas_udf("struct<charge:array<double>,discharge:array<double>>")
    def plan(prices: pd.Series, step_hours: pd.Series) -> pd.DataFrame:
        charge, discharge = [], []
        for at in range(0, len(prices), _BLOCK):
            c, d = battery_plans(
                [np.asarray(p, dtype=float) for p in prices.iloc[at : at + _BLOCK]],
                step_hours.iloc[at : at + _BLOCK].to_numpy(dtype=float),
                battery,
            )
            charge += c
            discharge += d
        return pd.DataFrame({"charge": charge, "discharge": discharge})

    return plan


def battery_profit(prices: Column, plan: Column, battery: Battery = Battery()) -> Column:
    """Profit of a plan at the given prices, net of wear, computed inside the row."""
    net = F.zip_with(plan["discharge"], plan["charge"], lambda d, c: d - c)
    earned = F.aggregate(
        F.zip_with(prices, net, lambda p, x: p * x), F.lit(0.0), lambda acc, x: acc + x
    )
    wear = F.aggregate(plan["discharge"], F.lit(0.0), lambda acc, x: acc + x)
    return earned - F.lit(battery.wear_per_kwh) * wear


def grid_states(step_kwh: float, battery: Battery) -> tuple[int, int]:
    """How many states of charge there are in steps of ``step_kwh``, and which one the day starts in."""
    last, start = battery.capacity_kwh / step_kwh, battery.start_soc_kwh / step_kwh
    if last != int(last) or start != int(start):
        raise ValueError(f"capacity and start must be whole steps of {step_kwh} kWh")
    return int(last) + 1, int(start)


def grid_plan(prices: Column, step_hours: float, battery: Battery = Battery(round_trip=1.0)) -> Column:
    """The best plan of a lossless battery over a day's prices -> struct<profit, moves>, inside the row and without Python.

    Without loss the linear programme is a flow, whose best plans move by whole steps (power times slot length), so states of charge are
    a small grid. One fold over the prices keeps the greatest profit of each state and how it was reached; a second one
    walks back from the required last state. A move is -1 (discharge), 0 or 1 (charge); standing still wins ties, then charging.
    A recursive query would say the same, but takes a job a slot and bounds the rows of all days together; a fold is a projection.
    """
    step = battery.power_kw * step_hours
    n, start = grid_states(step, battery)
    states = F.sequence(F.lit(0), F.lit(n - 1))
    none = F.lit(None).cast("double")

    def reached(best: Column, price: Column) -> Column:
        """Of each state: struct<profit, move> of the best way there; the struct's order breaks ties."""

        def ways(s: Column) -> Column:
            ways = (
                (F.get(best, s), 2, 0),
                (F.when(s > 0, F.get(best, s - 1)) - price * step, 1, 1),
                (F.when(s < n - 1, F.get(best, s + 1)) + (price - battery.wear_per_kwh) * step, 0, -1),
            )
            return F.greatest(
                *[
                    F.when(v.isNotNull(), F.struct(v.alias("v"), F.lit(r).alias("r"), F.lit(m).cast("tinyint").alias("move")))
                    for v, r, m in ways
                ]
            )

        return F.transform(states, ways)

    first = F.transform(states, lambda s: F.when(s == start, F.lit(0.0)).otherwise(none))
    begin = F.struct(first.alias("best"), F.array().cast("array<array<tinyint>>").alias("moves"))

    def step_on(acc: Column, price: Column) -> Column:
        # Bound through a one-element array, so that the ways are worked out once.
        found = F.array(reached(acc["best"], price))
        return F.transform(
            found,
            lambda f: F.struct(
                F.transform(f, lambda x: x["v"]).alias("best"),
                F.concat(acc["moves"], F.array(F.transform(f, lambda x: x["move"]))).alias("moves"),
            ),
        )[0]

    done = F.aggregate(prices, begin, step_on)

    def back(acc: Column, moves: Column) -> Column:
        move = F.get(moves, acc["state"])
        return F.struct((acc["state"] - move.cast("int")).alias("state"), F.concat(F.array(move), acc["plan"]).alias("plan"))

    end = F.struct(F.lit(start).alias("state"), F.array().cast("array<tinyint>").alias("plan"))
    return F.transform(
        F.array(done),
        lambda d: F.struct(
            F.get(d["best"], F.lit(start)).alias("profit"),
            F.aggregate(F.reverse(d["moves"]), end, back)["plan"].alias("moves"),
        ),
    )[0]


def plan_checks(plan: Column, step_hours: Column, battery: Battery = Battery(), slack: float = 1e-6) -> dict[str, Column]:
    """Whether a plan (struct<charge, discharge>) keeps the state of charge, the power limits and the required last state."""
    eta = battery.round_trip**0.5
    flow = F.zip_with(plan["charge"], plan["discharge"], lambda c, d: c * F.lit(eta) - d / F.lit(eta))
    begin = F.struct(*[F.lit(float(battery.start_soc_kwh)).alias(c) for c in ("soc", "low", "high")])
    path = F.aggregate(
        flow,
        begin,
        lambda acc, x: F.struct(
            (acc["soc"] + x).alias("soc"), F.least(acc["low"], acc["soc"] + x).alias("low"), F.greatest(acc["high"], acc["soc"] + x).alias("high")
        ),
    )
    limit = F.lit(battery.power_kw) * step_hours + slack
    powered = lambda side: F.forall(plan[side], lambda x: (x >= -slack) & (x <= limit))
    return {
        "soc_within": (path["low"] >= -slack) & (path["high"] <= battery.capacity_kwh + slack),
        "power_within": powered("charge") & powered("discharge"),
        "ends_at_start": F.abs(path["soc"] - battery.start_soc_kwh) <= slack,
    }
