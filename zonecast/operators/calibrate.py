"""Conformal calibration of the outer quantiles, per model, zone and fold.

The margin of a fold is an exact order statistic of how far earlier actuals fell outside the raw
interval. A (model, zone, fold) group holds the slots of 90 days, a couple of thousand rows at
most, because predictions are unique per (model, zone, hour).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import MIN_POINTS, TARGET_COVERAGE, WINDOW_DAYS
from zonecast.functions.numeric import conformal_score


def margin_rank(n: Column, coverage: float = TARGET_COVERAGE) -> Column:
    """Zero-based rank of the margin among n ascending scores."""
    level = F.least(F.lit(1.0), F.ceil((n + 1) * F.lit(coverage)) / n)
    return F.ceil((n - 1) * level)


def margins(
    scores: DataFrame, *keys: str, coverage: float = TARGET_COVERAGE, min_points: int = MIN_POINTS
) -> DataFrame:
    """(keys, n_scores, interval_margin) from rows of (keys, score); short groups are left out.

    A null score, of a forecast that couldn't be made, counts for nothing.
    """
    group = Window.partitionBy(*keys)
    return (
        scores.where(F.col("score").isNotNull())
        .withColumn("n_scores", F.count("*").over(group))
        .withColumn("place", F.row_number().over(group.orderBy("score")) - 1)
        .where((F.col("n_scores") >= min_points) & (F.col("place") == margin_rank(F.col("n_scores"), coverage)))
        .select(*keys, "n_scores", F.col("score").alias("interval_margin"))
    )


def folds_served(day: Column | str, window_days: int = WINDOW_DAYS) -> Column:
    """First-of-month dates f with f - window_days <= day < f.

    Sending each day to the two to four folds it serves turns the range join of folds with
    their history into an equi-join.
    """
    d = F.col(day) if isinstance(day, str) else day
    first = F.add_months(F.trunc(d, "MM"), 1)
    last = F.date_add(d, window_days)
    return F.filter(
        F.sequence(first, F.greatest(first, last), F.expr("interval 1 month")), lambda f: f <= last
    )


def fold_margins(
    predictions: DataFrame,
    models: tuple[str, ...],
    window_days: int = WINDOW_DAYS,
    coverage: float = TARGET_COVERAGE,
    min_points: int = MIN_POINTS,
) -> DataFrame:
    """Margin of every (model, zone, fold), from the raw bounds of the days before the fold."""
    scores = predictions.where(F.col("model").isin(*models)).select(
        "model",
        "zone",
        conformal_score(F.col("target_price"), F.col("q10"), F.col("q90")).alias("score"),
        F.explode(folds_served("delivery_date", window_days)).alias("fold"),
    )
    return margins(scores, "model", "zone", "fold", coverage=coverage, min_points=min_points)


def apply_margin(margin: Column) -> dict[str, Column]:
    """Outer quantiles moved out (or in) by the margin, never past the median."""
    return {
        "q10": F.least(F.col("q10") - margin, F.col("q50")),
        "q90": F.greatest(F.col("q90") + margin, F.col("q50")),
    }


def calibrate(
    predictions: DataFrame,
    models: tuple[str, ...],
    window_days: int = WINDOW_DAYS,
    coverage: float = TARGET_COVERAGE,
    min_points: int = MIN_POINTS,
) -> DataFrame:
    """Predictions with calibrated bounds, the raw bounds and the margin used.

    Models not named keep their bounds and a margin of 0.
    """
    found = fold_margins(predictions, models, window_days, coverage, min_points).drop("n_scores")
    return (
        predictions.join(found, ["model", "zone", "fold"], "left")
        .withColumns(
            {
                "interval_margin": F.coalesce("interval_margin", F.lit(0.0)),
                "q10_raw": F.col("q10"),
                "q90_raw": F.col("q90"),
            }
        )
        .withColumns(
            {
                name: F.when(F.col("model").isin(*models), moved).otherwise(F.col(name))
                for name, moved in apply_margin(F.col("interval_margin")).items()
            }
        )
    )


def recent_margins(
    predictions: DataFrame,
    model: str,
    window_days: int = WINDOW_DAYS,
    coverage: float = TARGET_COVERAGE,
    min_points: int = MIN_POINTS,
) -> DataFrame:
    """(zone, interval_margin) from the newest out-of-sample days, on raw bounds if present."""
    low, high = (
        ("q10_raw", "q90_raw") if "q10_raw" in predictions.columns else ("q10", "q90")
    )
    mine = predictions.where(F.col("model") == model)
    newest = mine.agg(F.max("delivery_date")).scalar()
    scores = mine.where(F.col("delivery_date") > F.date_sub(newest, window_days)).select(
        "zone", conformal_score(F.col("target_price"), F.col(low), F.col(high)).alias("score")
    )
    return margins(scores, "zone", coverage=coverage, min_points=min_points)
