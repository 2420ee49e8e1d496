from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from zonecast.functions import clock
from zonecast.sources.generators import (
    calendar,
    date_series,
    holidays_of,
    int_range,
    month_series,
    months,
)


@pytest.mark.parametrize(
    ("day", "minutes", "expected"),
    [
        (date(2025, 6, 10), 60, 24),
        (date(2025, 3, 30), 60, 23),
        (date(2024, 10, 27), 60, 25),
        (date(2025, 10, 26), 15, 100),
        (date(2026, 3, 29), 15, 92),
    ],
)
@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_expected_intervals(spark, day, minutes, expected, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        row = spark.range(1).select(clock.expected_intervals(F.lit(day), minutes).alias("n")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["n"] == expected


def test_both_autumn_hours_are_local_two(spark):
    rows = spark.sql(
        "select explode(array(timestamp_ntz'2025-10-26 00:00:00', timestamp_ntz'2025-10-26 01:00:00')) as t"
    ).select(clock.local_hour("t").alias("h"), clock.iso_local("t").alias("iso"))
    assert [tuple(r) for r in rows.collect()] == [
        (2, "2025-10-26T02:00:00+02:00"),
        (2, "2025-10-26T02:00:00+01:00"),
    ]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_zoned_round_trip_keeps_the_instant(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.sql(
            "select explode(sequence(timestamp_ntz'2025-03-09 05:00:00', timestamp_ntz'2025-03-09 09:00:00', interval 30 minutes)) as t"
        )
        moved = df.where(clock.as_utc(clock.as_zoned("t")) != F.col("t")).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert moved == 0


def test_parse_instant(spark):
    texts = ["2025-06-10T00:00:00+02:00", "2025-01-01T00:00", "2025-01-01T00:00:00Z", "soon", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        clock.parse_instant(F.col("t"))
    )
    assert [r[0] for r in rows.collect()] == [
        datetime(2025, 6, 9, 22), datetime(2025, 1, 1), datetime(2025, 1, 1), None, None,
    ]


def test_minutes_floor(spark):
    row = spark.sql("select timestamp_ntz'2025-01-01 10:44:59.9' as t").select(
        clock.minutes_floor("t", 15).alias("q"), clock.hour_floor("t").alias("h")
    ).first()
    assert row["q"] == datetime(2025, 1, 1, 10, 30) and row["h"] == datetime(2025, 1, 1, 10)


def test_holiday_rule_gives_known_days(spark):
    years = spark.createDataFrame([(2024,), (2027,)], "year int")
    found = {r["holiday_date"]: r["holiday_name"] for r in holidays_of(years).collect()}
    assert len(found) == 26
    assert found[date(2024, 3, 29)] == "Långfredagen"
    assert found[date(2024, 3, 31)] == "Påskdagen; Söndag"
    assert found[date(2024, 6, 22)] == "Midsommardagen"
    assert found[date(2024, 11, 2)] == "Alla helgons dag"
    assert found[date(2027, 5, 6)] == "Kristi himmelsfärdsdag"
    assert found[date(2027, 6, 26)] == "Midsommardagen"
    assert found[date(2027, 12, 26)] == "Annandag jul; Söndag"


def test_calendar_flags(spark):
    days = calendar(date_series(spark, date(2024, 6, 5), date(2024, 6, 9)))
    rows = {r["date_day"].day: r for r in days.collect()}
    assert rows[6]["is_holiday"] and not rows[6]["is_workday"] and rows[6]["holiday_name"] == "Nationaldagen"
    assert rows[5]["is_workday"] and rows[8]["is_weekend"] and rows[9]["iso_dow"] == 7


def test_series(spark):
    got = [r["month"] for r in month_series(spark, date(2024, 11, 15), date(2025, 2, 1)).collect()]
    assert got == [date(2024, 11, 1), date(2024, 12, 1), date(2025, 1, 1), date(2025, 2, 1)]
    assert [r["k"] for r in int_range(spark, 3).collect()] == [0, 1, 2]
    one = spark.range(1).select(months(F.lit(date(2024, 1, 31)), F.lit(date(2024, 1, 31))).alias("m"))
    assert one.first()["m"] == [date(2024, 1, 1)]
