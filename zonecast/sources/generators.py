"""Generated tables: date and month series, the holiday rule, the calendar and the zone table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast import schemas
from zonecast.config import WEATHER_POINTS, ZONE_ROWS
from zonecast.functions.clock import iso_dow, month_start


def date_series(spark: SparkSession, first: date, last: date, name: str = "date_day") -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias(name)
    )


def days_between(bounds: DataFrame, first: str, last: str, name: str = "date_day", extra_days: int = 0) -> DataFrame:
    """Days from a one-row DataFrame of bounds, for a calendar that follows the data."""
    end = F.date_add(F.col(last), extra_days)
    return bounds.select(
        F.explode(F.sequence(F.col(first), end, F.expr("interval 1 day"))).alias(name)
    )


def int_range(spark: SparkSession, stop: int, name: str = "k") -> DataFrame:
    return spark.range(stop).select(F.col("id").cast("int").alias(name))


def months(first: Column, last: Column) -> Column:
    """Array of first-of-month dates from the month of ``first`` to ``last``."""
    return F.sequence(month_start(first), last, F.expr("interval 1 month"))


def month_series(spark: SparkSession, first: date, last: date, name: str = "month") -> DataFrame:
    return spark.range(1).select(F.explode(months(F.lit(first), F.lit(last))).alias(name))


# Swedish public holidays. A day offset is counted from Easter Sunday; a weekday
# rule is the Saturday in the seven days from the given month and day. The years are the first and
# last of a holiday that came or went.
FIXED_HOLIDAYS = (
    (1, 1, "Nyårsdagen"),
    (1, 6, "Trettondedag jul"),
    (5, 1, "Första maj"),
    (6, 6, "Nationaldagen"),
    (12, 25, "Juldagen"),
    (12, 26, "Annandag jul"),
)
EASTER_HOLIDAYS = (
    (-2, "Långfredagen"),
    (0, "Påskdagen"),
    (1, "Annandag påsk"),
    (39, "Kristi himmelsfärdsdag"),
    (49, "Pingstdagen"),
    (50, "Annandag pingst"),
)
SATURDAY_HOLIDAYS = (
    (6, 20, "Midsommardagen"),
    (10, 31, "Alla helgons dag"),
)
HOLIDAY_YEARS = {"Nationaldagen": (2005, 9999), "Annandag pingst": (0, 2004)}
SUNDAY_SUFFIX = "; Söndag"


def _with_easter(years: DataFrame) -> DataFrame:
    """Add Easter Sunday by the Meeus/Jones/Butcher rule, one named step per projection."""
    return (
        years.selectExpr(
            "year", "year % 19 as golden", "year div 100 as century", "year % 100 as in_century"
        )
        .selectExpr("*", "(century - (century + 8) div 25 + 1) div 3 as skipped")
        .selectExpr("*", "(19 * golden + century - century div 4 - skipped + 15) % 30 as moon")
        .selectExpr(
            "*",
            "(32 + 2 * (century % 4) + 2 * (in_century div 4) - moon - in_century % 4) % 7 as shift",
        )
        .selectExpr(
            "year",
            "moon + shift - 7 * ((golden + 11 * moon + 22 * shift) div 451) + 114 as march",
        )
        .selectExpr(
            "year",
            "make_date(year, cast(march div 31 as int), cast(march % 31 + 1 as int)) as easter",
        )
    )


def holidays_of(years: DataFrame) -> DataFrame:
    """Public holidays (holiday_date, holiday_name) of every ``year`` in the input."""
    year, easter = F.col("year"), F.col("easter")

    def entry(day: Column, name: str) -> Column:
        first, last = HOLIDAY_YEARS.get(name, (0, 9999))
        held = F.when(year.between(first, last), day)
        return F.struct(held.alias("holiday_date"), F.lit(name).alias("holiday_name"))

    entries = [entry(F.make_date(year, F.lit(m), F.lit(d)), n) for m, d, n in FIXED_HOLIDAYS]
    entries += [entry(F.date_add(easter, k), n) for k, n in EASTER_HOLIDAYS]
    entries += [
        entry(F.next_day(F.date_sub(F.make_date(year, F.lit(m), F.lit(d)), 1), "SAT"), n)
        for m, d, n in SATURDAY_HOLIDAYS
    ]
    named = _with_easter(years.select(F.col("year").cast("int"))).select(F.inline(F.array(*entries)))
    on_sunday = iso_dow("holiday_date") == 7
    return named.where(F.col("holiday_date").isNotNull()).select(
        "holiday_date",
        F.when(on_sunday, F.concat("holiday_name", F.lit(SUNDAY_SUFFIX)))
        .otherwise(F.col("holiday_name"))
        .alias("holiday_name"),
    )


def calendar(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar dimension over ``date_day``; holidays default to the rule above."""
    if holidays is None:
        holidays = holidays_of(days.select(F.year("date_day").alias("year")).distinct())
    dow = iso_dow("date_day")
    # One row per holiday, a dozen or so a year: broadcast is bounded by the calendar.
    return days.join(
        F.broadcast(holidays), F.col("holiday_date") == F.col("date_day"), "left"
    ).select(
        "date_day",
        F.year("date_day").alias("year"),
        F.month("date_day").alias("month"),
        dow.alias("iso_dow"),
        (dow >= 6).alias("is_weekend"),
        F.col("holiday_date").isNotNull().alias("is_holiday"),
        "holiday_name",
        ((dow < 6) & F.col("holiday_date").isNull()).alias("is_workday"),
    )


def zone_table(spark: SparkSession, rows: tuple = ZONE_ROWS) -> DataFrame:
    """Zone dimension: zone, its name and largest city."""
    return spark.createDataFrame(list(rows), schemas.ZONES_SEED)


def point_registry(spark: SparkSession, points: tuple = WEATHER_POINTS) -> DataFrame:
    """Weather points with their position in the payload."""
    return spark.createDataFrame(
        [(i, *p) for i, p in enumerate(points)],
        "position int, point string, zone string, lat double, lon double",
    )
