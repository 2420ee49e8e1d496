"""Whole-day validation of raw price days and weather payloads, and the quarantine status.

A raw day is one row holding an array of records. All rules are array expressions on that row:
no shuffle, no Python, and the work spreads over as many tasks as there are files. The first
failing rule, in the order of ``_first_failure``, is the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.config import MARKET_TZ, MAX_ABS_PRICE, RESOLUTIONS, WEATHER_VARIABLES
from zonecast.functions.clock import (
    expected_intervals,
    iso_local,
    parse_instant,
    plus_minutes,
    to_local,
)
from zonecast.functions.numeric import finite
from zonecast.sources.raw import month_of

# Keys of a raw price record and the columns they become.
NUMBER_KEYS = {
    "SEK_per_kWh": "price_sek_kwh",
    "EUR_per_kWh": "price_eur_kwh",
    "EXR": "eur_sek_rate",
}
TIME_KEY = "time_start"


def _text(record: Column, key: str) -> Column:
    return F.regexp_replace(F.try_element_at(record, F.lit(key)), '^"|"$', "")


def _fault(record: Column, key: str, parsed: Column, null_is_fault: bool) -> Column:
    raw = _text(record, key)
    bad = parsed.isNull() if null_is_fault else raw.isNotNull() & parsed.isNull()
    return F.when(~F.map_contains_key(record, key), F.lit(f"missing {key}")).when(
        bad, F.lit(f"bad {key}")
    )


def _typed(record: Column) -> Column:
    start = parse_instant(_text(record, TIME_KEY))
    numbers = {k: _text(record, k).try_cast("double") for k in NUMBER_KEYS}
    # A null start is no interval at all; a null number is a missing value, judged later.
    faults = [_fault(record, TIME_KEY, start, True)]
    faults += [_fault(record, k, v, False) for k, v in numbers.items()]
    return F.struct(
        start.alias("interval_start"),
        *[finite(v).alias(NUMBER_KEYS[k]) for k, v in numbers.items()],
        F.coalesce(*faults).alias("fault"),
    )


def _mode(values: Column) -> Column:
    """Most frequent element, the smallest on ties: one pass over the sorted array."""
    start = F.struct(
        F.lit(None).cast("double").alias("value"),
        F.lit(0).alias("run"),
        F.lit(None).cast("double").alias("best"),
        F.lit(0).alias("best_run"),
    )

    def step(acc: Column, x: Column) -> Column:
        run = F.when(acc["value"] == x, acc["run"] + 1).otherwise(F.lit(1))
        better = run > acc["best_run"]
        return F.struct(
            x.alias("value"),
            run.alias("run"),
            F.when(better, x).otherwise(acc["best"]).alias("best"),
            F.when(better, run).otherwise(acc["best_run"]).alias("best_run"),
        )

    return F.aggregate(F.array_sort(values), start, step, lambda acc: acc["best"])


def _bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a generator of one row.

    A later filter or projection then reads the computed value. With plain projections the
    optimizer would copy these long expressions into every place that mentions them.
    """
    one = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.inline(one))


def check_price_days(days: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """(zone, day, source, payload) -> the same keys with records, resolution and reason.

    ``reason`` is null for a good day. ``records`` are typed and sorted by start.
    """
    typed = _bind(days, records=F.array_sort(F.transform("payload", _typed)))
    starts = _bind(typed, starts=F.transform("records", lambda r: r["interval_start"]))
    gap = F.transform(
        F.slice("starts", F.lit(2), F.greatest(F.size("starts") - 1, F.lit(0))),
        lambda t, i: F.timestamp_diff("SECOND", F.get(F.col("starts"), i), t) / F.lit(60.0),
    )
    gaps = _bind(starts, gaps=gap)
    measured = _bind(
        gaps, resolution_minutes=F.coalesce(_mode(F.col("gaps")).cast("int"), F.lit(0))
    )
    return _bind(measured, reason=_first_failure(tz)).drop("starts", "gaps", "payload")


def _first_failure(tz: str) -> Column:
    resolution = F.col("resolution_minutes")
    first_start = F.get("starts", F.lit(0))
    first_local = to_local(first_start, tz)
    expected = expected_intervals("day", resolution, tz)
    faults = F.filter(F.transform("records", lambda r: r["fault"]), lambda f: f.isNotNull())
    price = lambda r: r["price_sek_kwh"]
    return (
        F.when(F.col("payload").isNull(), F.lit("malformed JSON"))
        .when(F.size("payload") == 0, F.lit("empty payload"))
        .when(F.size(faults) > 0, F.concat(F.lit("malformed record: "), F.get(faults, F.lit(0))))
        .when(
            F.size(F.array_distinct("starts")) < F.size("starts"),
            F.lit("duplicate interval starts"),
        )
        .when(
            ~resolution.isin(*RESOLUTIONS),
            F.concat(F.lit("interval length "), resolution.cast("string"), F.lit(" min")),
        )
        .when(
            first_local != F.col("day").cast("timestamp_ntz"),
            F.concat(F.lit("day starts at "), iso_local(first_start, tz)),
        )
        .when(
            F.exists("gaps", lambda g: g != resolution),
            F.lit("gap or overlap between intervals"),
        )
        .when(
            F.size("starts") != expected,
            F.concat(
                F.size("starts").cast("string"),
                F.lit(" intervals, expected "),
                expected.cast("string"),
            ),
        )
        .when(F.exists("records", lambda r: price(r).isNull()), F.lit("missing price"))
        .when(
            F.exists("records", lambda r: F.abs(price(r)) > MAX_ABS_PRICE),
            F.lit(f"price outside +/-{MAX_ABS_PRICE} SEK/kWh"),
        )
    )


def valid_intervals(checked: DataFrame) -> DataFrame:
    """Rows of the good days; the end comes from the resolution, not from the source."""
    return (
        checked.where(F.col("reason").isNull())
        .select("zone", F.col("day").alias("delivery_date"), "resolution_minutes", F.inline("records"))
        .select(
            "zone",
            "delivery_date",
            "interval_start",
            plus_minutes("interval_start", F.col("resolution_minutes")).alias("interval_end"),
            *NUMBER_KEYS.values(),
            "resolution_minutes",
        )
    )


def day_status(checked: DataFrame) -> DataFrame:
    """One row per checked day. Quarantine = rows with a reason; a repaired day turns to null."""
    return checked.select("zone", "day", "source", "reason", month_of("day").alias("month"))


def quarantined(status: DataFrame) -> DataFrame:
    return status.where(F.col("reason").isNotNull()).select("zone", "day", "source", "reason")


def build_stats(checked: DataFrame) -> DataFrame:
    """months_built, days_ok and days_quarantined of one build."""
    ok = F.col("reason").isNull()
    return checked.agg(
        F.count_distinct(F.when(ok, F.struct("zone", month_of("day")))).alias("months_built"),
        F.count_if(ok).alias("days_ok"),
        F.count_if(~ok).alias("days_quarantined"),
    )


def check_weather(payloads: DataFrame, registry: DataFrame, n_points: int, *keep: str) -> DataFrame:
    """Add the reason a weather payload is rejected (null = good).

    ``registry`` has one row per expected point, so it is as small as one payload.
    """
    names = registry.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("position", "point"))), lambda p: p["point"]
        ).alias("names")
    ).scalar()
    needed = F.array(*[F.lit(v) for v in ("time", *WEATHER_VARIABLES)])

    def fault(point: Column, i: Column) -> Column:
        absent = F.array_except(
            needed, F.coalesce(F.map_keys(point["hourly"]), F.array().cast("array<string>"))
        )
        return F.when(
            F.size(absent) > 0,
            F.concat(
                F.get(F.col("names"), i), F.lit(": missing ['"), F.array_join(absent, "', '"), F.lit("']")
            ),
        )

    # Points beyond the registry only matter for the count, which is judged first.
    faults = F.filter(F.transform("payload", fault), lambda f: f.isNotNull())
    reason = (
        F.when(F.col("payload").isNull(), F.lit("malformed JSON"))
        .when(
            F.size("payload") != n_points,
            F.concat(
                F.size("payload").cast("string"), F.lit(f" weather points, expected {n_points}")
            ),
        )
        .when(F.size(faults) > 0, F.get(faults, F.lit(0)))
    )
    return _bind(payloads.withColumn("names", names), reason=reason).select(
        *keep, "payload", "reason"
    )


def flatten_weather(checked: DataFrame, registry: DataFrame, *keep: str) -> DataFrame:
    """Good payloads to long rows: points by position, parallel arrays zipped by index."""
    points = checked.where(F.col("reason").isNull()).select(
        *keep, F.posexplode("payload").alias("position", "body")
    )
    hourly = lambda k: F.try_element_at(F.col("body.hourly"), F.lit(k))
    rows = points.join(F.broadcast(registry.select("position", "point", "zone")), "position").select(
        *keep,
        "point",
        "zone",
        F.inline(
            F.arrays_zip(
                hourly("time").alias("time"), *[hourly(v).alias(v) for v in WEATHER_VARIABLES]
            )
        ),
    )
    return rows.select(
        *keep,
        "point",
        "zone",
        parse_instant(F.col("time")).alias("valid_at"),
        *[finite(F.col(v).try_cast("double")).alias(v) for v in WEATHER_VARIABLES],
    )
