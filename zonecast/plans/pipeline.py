"""The three ways in: build, backtest and daily, each from stored tables to stored tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from zonecast.config import BACKTEST_START, EV, MIN_POINTS, ZONES, Battery
from zonecast.operators import report, score, value
from zonecast.operators.calibrate import recent_margins
from zonecast.operators.marts import interval_fact
from zonecast.operators.models import QuantileForest
from zonecast.operators.validate import quarantined
from zonecast.plans import daily, walkforward, warehouse
from zonecast.session import is_missing
from zonecast.sources import sinks, tables

CODES = {zone: code for code, zone in enumerate(ZONES)}
MODEL = "forest"


def run_backtest(
    spark: SparkSession,
    features: DataFrame,
    intervals: DataFrame,
    out: str,
    start: date = BACKTEST_START,
    forests: dict[str, QuantileForest] | None = None,
    zone_codes: dict[str, int] = CODES,
    min_points: int = MIN_POINTS,
    ev: EV = EV(),
    battery: Battery = Battery(),
) -> dict[str, DataFrame]:
    """Predict, calibrate, score and value every month from ``start``.

    Predictions and daily values are stored; scores, monthly errors and the value summary come
    from the stored tables and are written as report blocks.
    """
    forests = walkforward.FORESTS if forests is None else forests
    preds = walkforward.backtest(
        features, zone_codes, start, forests, min_points=min_points
    )
    sinks.overwrite_partitions(preds, f"{out}/predictions", "model", "fold")
    preds = spark.read.parquet(f"{out}/predictions")
    span = score.evaluation_period(preds).first()
    market = tables.load_interval_prices(intervals, span["first_day"], span["last_day"])
    values = value.daily_values(preds, market, MODEL, ev=ev, battery=battery)
    values.write.mode("overwrite").parquet(f"{out}/schedule_daily")
    values = spark.read.parquet(f"{out}/schedule_daily")
    models = (*walkforward.NAIVE, *forests)
    blocks = {
        "scores": score.score(preds, raw_models=tuple(forests)),
        "monthly_mae": score.monthly_errors(preds, models),
        "period": score.evaluation_period(preds),
        "value": value.value_summary(values, ev),
    }
    for name, block in blocks.items():
        sinks.write_report(block, f"{out}/report/{name}")
    return blocks


def margins_of(spark: SparkSession, out: str, min_points: int = MIN_POINTS) -> DataFrame:
    """Live margins from the stored predictions; none before the first backtest."""
    try:
        preds = spark.read.parquet(f"{out}/predictions")
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return spark.createDataFrame([], "zone string, interval_margin double")
    return recent_margins(preds, MODEL, min_points=min_points)


def run_daily(
    spark: SparkSession,
    raw_root: str,
    out: str,
    forest: QuantileForest = QuantileForest(),
    zone_codes: dict[str, int] = CODES,
    issued_at: datetime | None = None,
) -> bool:
    """Build what has landed, forecast the coming day once, refresh the report."""
    _, features = warehouse.build(spark, raw_root, out)
    new = daily.issue(
        features, f"{out}/issued", margins_of(spark, out), zone_codes, forest, issued_at=issued_at
    )
    export_report(spark, out)
    return new


def export_report(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Write every report block that comes from the warehouse and the issued log."""
    intervals = interval_fact(tables.scan_prices(spark, f"{out}/prices"))
    hourly = spark.read.parquet(f"{out}/fct_price_hourly")
    issued = tables.load_issued(spark, f"{out}/issued")
    scored = score.with_actuals(issued, hourly)
    held = quarantined(spark.read.parquet(f"{out}/price_status"))
    blocks = {
        "tomorrow": report.tomorrow(issued),
        "latest_actual": report.latest_actual(intervals),
        "recent_days": report.recent_days(spark.read.parquet(f"{out}/mart_daily_zone_stats")),
        "track_record": score.track_record_days(scored),
        "track_record_summary": score.track_record_summary(scored),
        "issue_log": score.issue_log(issued, scored),
        "timetable": report.timetable(issued),
        "zone_cards": report.zone_cards(issued, intervals),
        "pipeline": report.pipeline_health(intervals, held, warehouse.run_tests(spark, out)),
    }
    for name, block in blocks.items():
        sinks.write_report(block, f"{out}/report/{name}")
    return blocks
