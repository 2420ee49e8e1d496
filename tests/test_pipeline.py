"""The entry points end to end on small worlds."""

import json
from datetime import date, datetime, timedelta

import pytest
from documents import day_document, point_document, put
from pyspark.sql import functions as F
from test_forecasting import CODES, NO_WEATHER, SMALL, features

from zonecast.config import ZONES
from zonecast.plans import pipeline, warehouse
from zonecast.sources import tables


def test_backtest_scores_and_values(spark, tmp_path):
    table, out = features(spark, days=75), str(tmp_path / "out")
    table.write.parquet(f"{out}/features")
    table = spark.read.parquet(f"{out}/features")
    intervals = table.select(
        "zone", "delivery_date", F.col("hour_start").alias("interval_start"),
        F.lit(60).alias("resolution_minutes"), F.col("target_price").alias("price_sek_kwh"),
    )
    forests = {"forest": SMALL, "forest_no_weather": NO_WEATHER}
    blocks = pipeline.run_backtest(spark, table, intervals, out, date(2024, 2, 1), forests, CODES)
    overall = {r["model"]: r for r in blocks["scores"].where("scope = 'overall'").collect()}
    assert overall["forest"]["mae"] < overall["naive_day"]["mae"]
    assert overall["forest"]["coverage_80_uncalibrated"] is not None
    assert overall["naive_day"]["coverage_80_uncalibrated"] is None
    assert {r["part"] for r in blocks["value"].collect()} == {"all", *ZONES}
    text = "\n".join(r[0] for r in spark.read.text(f"{out}/report/monthly_mae").collect())
    assert {json.loads(line)["month"] for line in text.splitlines()} == {"2024-02", "2024-03"}
    margins = {r["zone"]: r["interval_margin"] for r in pipeline.margins_of(spark, out).collect()}
    assert set(margins) == set(ZONES)
    assert pipeline.margins_of(spark, str(tmp_path / "none")).count() == 0


@pytest.fixture(scope="module")
def world(tmp_path_factory):
    root = tmp_path_factory.mktemp("daily")
    start, days = date(2024, 3, 20), 14  # the spring change falls inside
    for d in range(days):
        day = start + timedelta(days=d)
        for i, zone in enumerate(ZONES):
            put(root / f"raw/prices/{zone}/{day:%Y}/{day}.json", day_document(day, seed=i))
    last = start + timedelta(days=days - 1)
    put(root / "raw/weather/archive/2024-03.json", point_document(start - timedelta(days=1), last))
    put(
        root / f"raw/weather/forecast/{last}.json",
        {"fetched_at": f"{last}T08:00:00Z", "points": point_document(last, last + timedelta(days=2))},
    )
    return root, last


def test_daily_run_issues_once_and_scores_later(spark, world):
    root, last = world
    raw, out = str(root / "raw"), str(root / "out")
    at = datetime(last.year, last.month, last.day, 8)
    assert pipeline.run_daily(spark, raw, out, SMALL, issued_at=at)
    assert not pipeline.run_daily(spark, raw, out, SMALL, issued_at=at)
    issued = tables.load_issued(spark, f"{out}/issued")
    assert issued.count() == 96 and issued.first()["delivery_date"] == last + timedelta(days=1)
    assert issued.first()["issued_at"] == at
    log = spark.read.json(f"{out}/report/issue_log").collect()
    assert [(r["status"], r["timing"]) for r in log] == [("waiting", "before")]

    # The next day's prices arrive: it is scored, and the day after is issued.
    after = last + timedelta(days=1)
    for i, zone in enumerate(ZONES):
        put(root / f"raw/prices/{zone}/{after:%Y}/{after}.json", day_document(after, seed=i))
    assert pipeline.run_daily(spark, raw, out, SMALL, issued_at=at + timedelta(days=1))
    log = spark.read.json(f"{out}/report/issue_log").orderBy("delivery_date").collect()
    assert [r["status"] for r in log] == ["scored", "waiting"]
    summary = spark.read.json(f"{out}/report/track_record_summary").first()
    assert summary["days"] == 1
    hourly = spark.read.parquet(f"{out}/fct_price_hourly")
    assert hourly.where(F.col("delivery_date") == F.lit(after)).count() == 96
    assert hourly.where("delivery_date = '2024-03-31'").count() == 4 * 23

    warehouse.register_views(spark, out)
    row = tables.query(
        spark, "select count(*) as n from fct_price_hourly where zone = :zone and delivery_date = :day",
        zone="SE3", day=after,
    ).first()
    assert row["n"] == 24
    assert tables.query(spark, "select * from dim_zone").count() == 4
