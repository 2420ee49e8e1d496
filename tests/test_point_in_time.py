"""The whole build from raw files, and the proof that features never see their own prices."""

from datetime import date, timedelta

import pytest
from documents import day_document, point_document, put
from pyspark.sql import functions as F

from zonecast.config import ZONES
from zonecast.operators import features as ft
from zonecast.operators import quality
from zonecast.plans import warehouse
from zonecast.sources import tables
from zonecast.sources.generators import calendar, date_series, zone_table

START, DAYS = date(2024, 1, 1), 21
LAST = START + timedelta(days=DAYS - 1)
SHOCK = START + timedelta(days=14)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    for d in range(DAYS):
        day = START + timedelta(days=d)
        for i, zone in enumerate(ZONES):
            put(root / f"raw/prices/{zone}/{day:%Y}/{day}.json", day_document(day, seed=i))
    put(root / "raw/weather/archive/2024-01.json", point_document(START, LAST))
    put(
        root / f"raw/weather/forecast/{LAST}.json",
        {"fetched_at": f"{LAST}T10:00:00+01:00", "points": point_document(LAST, LAST + timedelta(days=2))},
    )
    put(root / "raw/weather/forecast/2024-01-15.json", {"points": []})
    out = str(root / "out")
    stats, features = warehouse.build(spark, str(root / "raw"), out)
    return root, out, stats, features


def test_build_stats_and_tables(spark, built):
    root, out, stats, features = built
    assert stats == {
        "months_built": 4, "days_ok": 84, "days_quarantined": 0,
        "weather_months_built": 1, "weather_forecasts_built": 1,
    }
    assert features.count() == 4 * 24 * (DAYS - 7 + 1)
    assert len(features.columns) == 32
    held = spark.read.parquet(f"{out}/weather_forecast_status").where("reason is not null")
    assert held.first()["name"].isoformat() == "2024-01-15" or held.first()["name"] == "2024-01-15"
    first = tables.load_features(features).first()
    assert (first["delivery_date"], first["zone"]) == (START + timedelta(days=7), "SE1")
    prices = warehouse.interval_prices(spark, out, START, START)
    assert prices.count() == 96


def test_second_build_has_nothing_to_validate(spark, built):
    root, out, _, _ = built
    again = warehouse.build_validated(spark, str(root / "raw"), out)
    assert set(again.values()) == {0}


def test_data_tests_pass(spark, built):
    results = warehouse.run_tests(spark, built[1])
    failed = results.where("failures > 0").collect()
    assert failed == []
    assert quality.suite_summary(results).first().asDict() == {"passed": 22, "total": 22}


def test_no_feature_sees_its_own_price(spark, built):
    _, out, _, _ = built
    hourly = spark.read.parquet(f"{out}/fct_price_hourly")

    def build(panel):
        return ft.feature_table(
            panel,
            zone_table(spark),
            spark.read.parquet(f"{out}/dim_date"),
            spark.read.parquet(f"{out}/fct_weather_hourly"),
            tables.scan_weather_snapshots(spark, f"{out}/weather_forecast"),
        )

    report = quality.leak_report(build, hourly, SHOCK).first()
    assert report["checked_rows"] == 96 and report["leaked_rows"] == 0
    assert report["next_day_rows"] == 96 and report["next_day_moved"] > 0.9 * 96

    def leaking(panel):
        same = panel.select("zone", "hour_start", F.col("price_sek_kwh").alias("own"))
        return build(panel).join(same, ["zone", "hour_start"], "left")

    assert quality.leak_report(leaking, hourly, SHOCK).first()["leaked_rows"] == 96


def test_next_day_rows_carry_forecast_weather(spark, built):
    live = ft.live(built[3]).collect()
    assert len(live) == 96 and {r["delivery_date"] for r in live} == {LAST + timedelta(days=1)}
    assert all(r["weather_source"] == "forecast" and r["temperature_c"] is not None for r in live)


def hours_of(spark, first, last, price):
    """Hourly panel of one zone over local days, priced by an expression of hour_start."""
    from zonecast.functions.clock import day_start_utc, local_date, local_hour, plus_hours

    days = date_series(spark, first, last, "delivery_date")
    return (
        days.select("delivery_date", F.explode(F.sequence(F.lit(0), F.lit(25))).alias("k"))
        .withColumn("hour_start", plus_hours(day_start_utc("delivery_date"), F.col("k")))
        .where(local_date("hour_start") == F.col("delivery_date"))
        .select(
            F.lit("SE3").alias("zone"), "delivery_date", "hour_start",
            local_hour("hour_start").alias("hour_local"), price.cast("double").alias("price_sek_kwh"),
        )
    )


def test_lags_around_the_clock_changes(spark):
    autumn = hours_of(spark, date(2025, 10, 25), date(2025, 10, 27), F.col("k"))
    lags = {
        (r["delivery_date"].day, r["hour_local"]): r["lag_1d"]
        for r in ft.seasonal_lags(autumn).collect()
    }
    assert lags[(27, 2)] == 2.5  # the mean of the repeated hour (k = 2 and 3)
    joined = autumn.join(ft.seasonal_lags(autumn), ["zone", "delivery_date", "hour_local"], "left")
    twice = joined.where("delivery_date = '2025-10-26' and hour_local = 2").collect()
    assert [r["lag_1d"] for r in twice] == [2.0, 2.0]
    spring = hours_of(spark, date(2025, 3, 29), date(2025, 3, 31), F.col("k"))
    after = spring.join(ft.seasonal_lags(spring), ["zone", "delivery_date", "hour_local"], "left")
    gap = after.where("delivery_date = '2025-03-31' and hour_local = 2").first()
    assert gap["lag_1d"] is None and gap["lag_2d"] == 2.0


def test_trailing_mean_is_by_calendar_and_change_by_row(spark):
    days = [(1, 1.0), (2, 3.0), (9, 5.0)]
    panel = spark.createDataFrame(
        [("Z", date(2025, 1, d), v) for d, v in days], "zone string, delivery_date date, day_mean double"
    )
    rows = {r["delivery_date"].day: r for r in ft.trailing(panel).collect()}
    assert rows[2]["week_mean"] == 2.0 and rows[9]["week_mean"] == 5.0
    assert rows[9]["day_mean_change"] == 2.0 and rows[1]["day_mean_change"] is None


def test_stale_snapshot_leaves_the_live_day_without_weather(spark):
    hourly = hours_of(spark, date(2025, 1, 1), date(2025, 1, 10), F.col("k"))
    points = "point string, zone string, valid_at timestamp_ntz, temperature_2m double, wind_speed_100m double, shortwave_radiation double, cloud_cover double"
    snapshots = spark.createDataFrame([], "issue_date date, " + points)
    archive = spark.createDataFrame(
        [], "zone string, valid_at timestamp_ntz, temperature_c double, wind_100m_ms double, solar_w_m2 double, cloud_cover_pct double"
    )
    table = ft.feature_table(
        hourly, hourly.select("zone").distinct(),
        calendar(date_series(spark, date(2025, 1, 1), date(2025, 1, 12))), archive, snapshots,
    )
    live = ft.live(table).collect()
    assert len(live) == 24 and all(r["temperature_c"] is None for r in live)
