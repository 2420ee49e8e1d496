"""Data-quality operators: each returns the violating rows, none when the data is good."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.config import MARKET_TZ
from zonecast.functions.clock import day_minutes


def not_null(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.where(F.col(column).isNull())


def unique_combination(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that appear more than once, with their count."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def unique(df: DataFrame, column: str) -> DataFrame:
    """As above for a single column; nulls do not count."""
    return unique_combination(df.where(F.col(column).isNotNull()), column)


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Values missing in the parent table, with their count; nulls pass.

    Rows are counted per value before the join, so a value that fills the table is one row there.
    """
    keys = parent.select(F.col(field).alias(column)).distinct()
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return values.join(keys, column, "left_anti")


def accepted_values(df: DataFrame, column: str, *values: object) -> DataFrame:
    """Values outside the list, with their count; nulls pass."""
    return (
        df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))
    )


def incomplete_days(intervals: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """Zone-days whose intervals do not fill the local day."""
    days = intervals.groupBy("zone", "delivery_date").agg(
        F.min("resolution_minutes").alias("resolution_minutes"),
        F.count("*").alias("intervals"),
    )
    lengths = days.withColumn("day_minutes", day_minutes("delivery_date", tz))
    return lengths.where(
        F.col("intervals") * F.col("resolution_minutes") != F.col("day_minutes")
    )


def coverage(facts: DataFrame, covariates: DataFrame, *on: str) -> DataFrame:
    """Share of fact rows with a match, in one row."""
    marked = covariates.select(*on).distinct().withColumn("matched", F.lit(1))
    return (
        facts.join(marked, list(on), "left")
        .agg(F.count("*").alias("hours"), F.count("matched").alias("with_weather"))
        .withColumn("coverage", F.try_divide("with_weather", "hours"))
    )


def low_coverage(facts: DataFrame, covariates: DataFrame, *on: str, least: float = 0.99) -> DataFrame:
    return coverage(facts, covariates, *on).where(
        F.col("with_weather") < F.lit(least) * F.col("hours")
    )


def row_checks(df: DataFrame, violations: dict[str, Column]) -> DataFrame:
    """Failure counts of any number of row-level tests in one pass over the table."""
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in violations.items()])
    entries = [
        F.struct(F.lit(name).alias("test"), F.col(name).alias("failures")) for name in violations
    ]
    return counts.select(F.inline(F.array(*entries)))


@dataclass(frozen=True)
class Known:
    """Rows whose ``columns`` are in ``parent`` (``fields``, of the same names where not given).

    Without ``least`` each row that has the columns and is not there fails; with it the test fails once if less than that share of
    all rows is there.
    """

    columns: tuple[str, ...]
    parent: DataFrame
    fields: tuple[str, ...] = ()
    least: float | None = None


def table_tests(
    df: DataFrame,
    key: dict[str, tuple[str, ...]],
    rules: dict[str, Column] | None = None,
    known: dict[str, Known] | None = None,
    filled: dict[str, tuple[str, ...]] | None = None,
    tz: str = MARKET_TZ,
) -> DataFrame:
    """(test, failures) of all tests of a table, in one scan of it.

    ``key`` names a test that no combination of columns is repeated (a single null column does not count), ``rules`` tests of single rows,
    ``known`` tests against a parent, and ``filled`` a test that the intervals of each (zone, day) fill the local day. Rows are marked with
    what holds for each of them, counted by key, and day if need be, before they are sent, and summed up.
    """
    rules, known, filled = rules or {}, known or {}, filled or {}
    marked, marks = df, dict(rules)
    for i, (test, k) in enumerate(known.items()):
        parent = k.parent.select(*[F.col(f).alias(f"_{i}_{c}") for c, f in zip(k.columns, k.fields or k.columns, strict=True)])
        parent = parent.distinct().withColumn(f"_{i}_found", F.lit(True))
        marked = marked.join(parent, reduce(and_, [F.col(c) == F.col(f"_{i}_{c}") for c in k.columns]), "left")
        absent = F.col(f"_{i}_found").isNull()
        has_all = reduce(and_, [F.col(c).isNotNull() for c in k.columns])
        marks[test] = absent if k.least is not None else absent & has_all
    (unique_test, columns), *_ = key.items()
    (filled_test, day), *_ = [*filled.items(), ("", ())]
    marked = marked.withColumns({f"_mark_{i}": F.coalesce(m, F.lit(False)).cast("long") for i, m in enumerate(marks.values())})
    sums = [F.sum(f"_mark_{i}").alias(f"_mark_{i}") for i in range(len(marks))]
    if day:
        groups = marked.groupingSets([list(columns), list(day)], *dict.fromkeys((*columns, *day)))
        by_key = F.grouping(next(c for c in day if c not in columns)) == 1
        length = day_minutes(day[-1], tz)
        short = F.count_if(~F.col("_by_key") & (F.col("_n") * F.col("_resolution") != length))
        extra = [F.min("resolution_minutes").alias("_resolution")]
    else:
        groups, by_key, short, extra = marked.groupBy(*columns), F.lit(True), F.lit(0), []
    counted = groups.agg(F.count("*").alias("_n"), by_key.alias("_by_key"), *sums, *extra)
    repeated = F.col("_n") > 1
    if len(columns) == 1:
        repeated &= F.col(columns[0]).isNotNull()
    one = counted.agg(
        F.count_if(F.col("_by_key") & repeated).alias("_repeated"),
        short.alias("_short"),
        F.coalesce(F.sum(F.when(F.col("_by_key"), F.col("_n"))), F.lit(0)).alias("_rows"),
        *[F.coalesce(F.sum(F.when(F.col("_by_key"), F.col(f"_mark_{i}"))), F.lit(0)).alias(f"_mark_{i}") for i in range(len(marks))],
    )
    found = {unique_test: F.col("_repeated"), **({filled_test: F.col("_short")} if day else {})}
    for i, test in enumerate(marks):
        least = known[test].least if test in known else None
        failed = F.col("_rows") - F.col(f"_mark_{i}") < F.lit(least) * F.col("_rows") if least is not None else None
        found[test] = F.col(f"_mark_{i}") if failed is None else failed.cast("long")
    return one.select(F.inline(F.array(*[F.struct(F.lit(t).alias("test"), c.cast("long").alias("failures")) for t, c in found.items()])))


def warehouse_tests(
    zones: DataFrame, days: DataFrame, intervals: DataFrame, hourly: DataFrame, weather: DataFrame, stats: DataFrame, features: DataFrame
) -> DataFrame:
    """The 22 data tests of a build: (test, failures), one scan a table.

    ``zones`` and ``days`` are what the facts are held against, so they must come from elsewhere.
    """
    null = lambda c: F.col(c).isNull()
    no_lag = lambda c: null(c) & (F.col("hour_local") != 2)
    return suite(
        table_tests(zones, {"unique_dim_zone_zone": ("zone",)}, {"not_null_dim_zone_zone": null("zone")}),
        table_tests(days, {"unique_dim_date_date_day": ("date_day",)}, {"not_null_dim_date_date_day": null("date_day")}),
        table_tests(
            intervals,
            {"unique_fct_price_interval": ("zone", "interval_start")},
            {
                "not_null_fct_price_interval_zone": null("zone"),
                "not_null_fct_price_interval_delivery_date": null("delivery_date"),
                "not_null_fct_price_interval_price_sek_kwh": null("price_sek_kwh"),
                "accepted_fct_price_interval_resolution": ~F.col("resolution_minutes").isin(15, 60),
            },
            {
                "relationships_fct_price_interval_zone": Known(("zone",), zones),
                "relationships_fct_price_interval_delivery_date": Known(("delivery_date",), days, ("date_day",)),
            },
            {"complete_delivery_days": ("zone", "delivery_date")},
        ),
        table_tests(
            hourly,
            {"unique_fct_price_hourly": ("zone", "hour_start")},
            {"accepted_fct_price_hourly_n_intervals": ~F.col("n_intervals").isin(1, 4)},
            {"weather_covers_prices": Known(("zone", "hour_start"), weather, ("zone", "valid_at"), least=0.99)},
        ),
        table_tests(weather, {"unique_fct_weather_hourly": ("zone", "valid_at")}),
        table_tests(stats, {"unique_mart_daily_zone_stats": ("zone", "delivery_date")}),
        table_tests(
            features,
            {"unique_feat_price_hourly": ("zone", "hour_start")},
            {
                "not_null_feat_lag_1d": no_lag("lag_1d"),
                "not_null_feat_lag_7d": no_lag("lag_7d"),
                "not_null_feat_prev_day_mean": null("prev_day_mean"),
                "not_null_feat_issue_date": null("issue_date"),
            },
        ),
    )


def failures(name: str, violating: DataFrame) -> DataFrame:
    return violating.agg(F.count("*").alias("failures")).select(F.lit(name).alias("test"), "failures")


def suite(*parts: DataFrame) -> DataFrame:
    """One (test, failures) row per test."""
    return reduce(DataFrame.unionByName, parts)


def suite_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("failures") == 0).alias("passed"), F.count("*").alias("total")
    )


def shocked(panel: DataFrame, day: date | Column, factor: float, price: str = "price_sek_kwh") -> DataFrame:
    """The panel with one day's prices multiplied."""
    at = F.col("delivery_date") == (F.lit(day) if isinstance(day, date) else day)
    return panel.withColumn(price, F.when(at, F.col(price) * factor).otherwise(F.col(price)))


def _comparable(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles rounded: two runs may add the same numbers in a different order."""
    return df.select(
        [
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema.fields
        ]
    )


def leak_report(
    build: Callable[[DataFrame], DataFrame],
    panel: DataFrame,
    day: date,
    factor: float = 10.0,
    label: str = "target_price",
) -> DataFrame:
    """Rebuild the features with one day's prices multiplied and compare, in one row.

    ``leaked_rows`` counts feature rows of that day that changed although only the prices they
    forecast did: it must be 0. ``next_day_moved`` counts next-day lags that grew: the guard that
    the shock arrived at all. Both builds are keyed by (zone, hour_start), so one join does.
    """
    keys = ["zone", "hour_start"]
    window = F.col("delivery_date").between(F.lit(day), F.date_add(F.lit(day), 1))

    def packed(features: DataFrame, name: str) -> DataFrame:
        rows = _comparable(features.where(window).drop(label))
        return rows.select(
            *keys, F.struct(*[c for c in rows.columns if c not in keys]).alias(name)
        )

    pairs = packed(build(panel), "before").join(
        packed(build(shocked(panel, day, factor)), "after"), keys, "full_outer"
    )
    on = F.coalesce("before.delivery_date", "after.delivery_date")
    at, after = on == F.lit(day), on == F.date_add(F.lit(day), 1)
    moved = F.abs("after.lag_1d") > F.abs("before.lag_1d")
    return pairs.agg(
        F.count_if(at).alias("checked_rows"),
        F.count_if(at & ~F.col("before").eqNullSafe(F.col("after"))).alias("leaked_rows"),
        F.count_if(after).alias("next_day_rows"),
        F.count_if(after & moved).alias("next_day_moved"),
    )
