"""Quantile-forest queries on the daily order panel with shipment covariates (no SQL form)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.config import FIRST_FEATURE_DAY, WINDOW_DAYS
from zonecast.functions.clock import day_start_utc
from zonecast.operators import features as ft
from zonecast.operators import score as sc
from zonecast.operators.calibrate import recent_margins
from zonecast.operators.marts import weather_fact
from zonecast.operators.models import QuantileForest, input_columns
from zonecast.plans import panels, walkforward
from zonecast.plans.daily import MODEL_VERSION, issue
from zonecast.plans.shape import big, rounded, six
from zonecast.plans.sqltext import DAILY_PANEL, with_ctes
from zonecast.session import materialise, scratch_path
from zonecast.sources.tables import driver_table

NEIGHBOURS = {
    "1-URGENT": "prev_urgent_mean",
    "3-MEDIUM": "prev_medium_mean",
    "5-LOW": "prev_low_mean",
}
PRICES = (
    "lag_1d", "lag_2d", "lag_7d", "prev_day_mean", "prev_week_mean", "prev_day_mean_change",
    *NEIGHBOURS.values(),
)
# Months of training data before the first month that is predicted, as in the reference; every later one is.
WARM_UP_MONTHS = 14
MIN_DAYS = 30


def ship_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments of a priority's orders as covariates, one point per return flag and ship day.

    ``orders`` has one row per key, so an order with very many lines is a skewed partition on one
    side only, which AQE splits; summing per order first would shuffle all lines twice.
    """
    orders = driver_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("zone")
    )
    return (
        driver_table(spark, sf_dir, "lineitem")
        .join(orders, "l_orderkey")
        .groupBy("zone", F.col("l_returnflag").alias("point"), F.col("l_shipdate").cast("date").alias("day"))
        .agg(
            (panels.exact_mean("l_discount") * 100).alias("temperature_2m"),
            panels.exact_mean("l_quantity").alias("wind_speed_100m"),
            F.count("*").cast("double").alias("shortwave_radiation"),
            (panels.exact_mean("l_tax") * 100).alias("cloud_cover"),
        )
        .select("point", "zone", day_start_utc("day").alias("valid_at"), *panels.WEATHER)
    )


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored feature table of the order panel: one slot per day, the coming day unlabelled."""
    panel = materialise(
        panels.daily_panel(spark, sf_dir).withColumn("hour_start", day_start_utc("delivery_date")),
        "order-days",
    )
    points = materialise(ship_points(spark, sf_dir), "ship-points")
    table = ft.feature_table(
        panel,
        panel.select("zone").distinct(),
        panels.calendar_of(panel),
        weather_fact(points),
        panels.as_snapshots(points),
        neighbours=NEIGHBOURS,
        northern=("1-URGENT", "2-HIGH"),
    ).where(F.col("hour_local") == 0)
    return materialise(table, "order-features")


INPUTS = {
    "forest_no_weather": input_columns(False, PRICES),
    "forest": input_columns(True, PRICES),
}


def zone_codes(features: DataFrame) -> dict[str, int]:
    """A code for each zone of the panel (its length is the number of zones, not of rows)."""
    return {r["zone"]: i for i, r in enumerate(features.select("zone").distinct().orderBy("zone").collect())}


def first_fold(features: DataFrame) -> date:
    """The month after the warm-up."""
    first = F.add_months(F.trunc(F.min("delivery_date"), "MM"), WARM_UP_MONTHS)
    return ft.labelled(features).agg(first.alias("d")).first()["d"]


def recent_fold(features: DataFrame, days: int = WINDOW_DAYS) -> date:
    """The first month that the last ``days`` labelled days touch."""
    first = F.trunc(F.date_sub(F.max("delivery_date"), days), "MM")
    return ft.labelled(features).agg(first.alias("d")).first()["d"]


def _backtest(spark: SparkSession, sf_dir: str, features: DataFrame) -> DataFrame:
    codes = zone_codes(features)
    return walkforward.backtest(features, codes, first_fold(features), inputs=INPUTS, min_points=MIN_DAYS)


def quantile_forest_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated walk-forward predictions of both forests and both naive models."""
    preds = _backtest(spark, sf_dir, order_features(spark, sf_dir))
    return preds.select(
        "model", "zone", "fold", "delivery_date", *six("target_price", "q10", "q50", "q90", "interval_margin")
    )


def quantile_forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds = materialise(_backtest(spark, sf_dir, order_features(spark, sf_dir)), "predictions")
    scores = sc.score(preds, raw_models=("forest", "forest_no_weather"))
    numbers = [c for c in scores.columns if c not in ("scope", "part", "model", "n")]
    return scores.select("scope", "part", "model", "n", *six(*numbers))


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of the inputs in a forest trained on every labelled day."""
    features = order_features(spark, sf_dir)
    fitted = QuantileForest().fit(ft.labelled(features), zone_codes(features), INPUTS["forest"])
    return fitted.importance().select("input", rounded("importance").alias("importance"))


def live_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coming day forecast by a forest, calibrated by recent errors, issued once."""
    features = order_features(spark, sf_dir)
    codes = zone_codes(features)
    history = walkforward.run(
        features, codes, recent_fold(features), {"forest": QuantileForest()}, {"forest": INPUTS["forest"]}
    )
    margins = recent_margins(history, "forest", min_points=MIN_DAYS)
    path = scratch_path(spark, "issued")
    # Eight in the morning of the day before the one to come.
    newest = features.where(F.col("target_price").isNull()).agg(F.max("issue_date").alias("d")).first()["d"]
    when = datetime(newest.year, newest.month, newest.day, 8)
    for _ in range(2):  # the second run finds the day issued and leaves it alone
        issue(features, path, margins, codes, inputs=INPUTS["forest"], issued_at=when)
    return spark.read.parquet(path).select(
        "zone", "delivery_date", *big("hour_local"), *six("q10", "q50", "q90", "interval_margin", "naive_day"),
        "issued_at", "model_version", "trained_through",
    )


def forest_prediction_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the backtest whatever the forests answer, by model and month: its rows, their days, the order of the
    quantiles, and that a forest answers every row and a naive model keeps margin 0."""
    preds = _backtest(spark, sf_dir, order_features(spark, sf_dir))
    is_forest = F.col("model").isin(*INPUTS)
    ordered = F.coalesce((F.col("q10") <= F.col("q50")) & (F.col("q50") <= F.col("q90")), ~is_forest)
    return preds.groupBy("model", "fold").agg(
        F.count("*").alias("n"),
        F.count_distinct("zone").alias("zones"),
        F.min("delivery_date").alias("first_day"),
        F.max("delivery_date").alias("last_day"),
        F.bool_and(ordered).alias("ordered"),
        F.bool_and(F.when(is_forest, F.col("q50").isNotNull()).otherwise(F.col("interval_margin") == 0)).alias("as_its_model"),
    )


_KNOWN = f"""known as (
    select zone, delivery_date from hourly
    where delivery_date >= (select min(delivery_date) + {FIRST_FEATURE_DAY} from hourly))"""
FOREST_PREDICTION_CHECKS = with_ctes(
    DAILY_PANEL,
    _KNOWN,
    select=f"""
    select model, cast(date_trunc('month', delivery_date) as date) as fold, count(*) as n, count(distinct zone) as zones,
           min(delivery_date) as first_day, max(delivery_date) as last_day, true as ordered, true as as_its_model
    from known, (values ('forest'), ('forest_no_weather'), ('naive_day'), ('naive_week')) as m(model)
    where delivery_date >= (select date_trunc('month', min(delivery_date)) + interval {WARM_UP_MONTHS} month from known)
    group by all""",
)


def live_issue_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the issued day: which zones it has, when it was issued and on what it was trained, and that its quantiles are in order."""
    ordered = (F.col("q10") <= F.col("q50")) & (F.col("q50") <= F.col("q90"))
    return live_issue(spark, sf_dir).select(
        "zone", "delivery_date", "hour_local", "issued_at", "model_version", "trained_through", ordered.alias("ordered")
    )


LIVE_ISSUE_CHECKS = with_ctes(
    DAILY_PANEL,
    select=f"""
    select distinct zone, last + 1 as delivery_date, cast(0 as bigint) as hour_local,
           cast(last as timestamp) + interval 8 hours as issued_at, '{MODEL_VERSION}' as model_version, last as trained_through,
           true as ordered
    from hourly, (select max(delivery_date) as last from hourly)""",
)

QUERIES = {
    "quantile_forest_backtest": (quantile_forest_backtest, None),
    "quantile_forest_scores": (quantile_forest_scores, None),
    "feature_importance": (feature_importance, None),
    "live_issue": (live_issue, None),
    "forest_prediction_checks": (forest_prediction_checks, FOREST_PREDICTION_CHECKS),
    "live_issue_checks": (live_issue_checks, LIVE_ISSUE_CHECKS),
}
