"""Walk-forward backtest: monthly expanding window, calibrated afterwards."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from zonecast.config import BACKTEST_START, MIN_POINTS
from zonecast.operators.calibrate import calibrate
from zonecast.operators.features import labelled
from zonecast.operators.models import (
    KEY_COLUMNS,
    QuantileForest,
    design_matrix,
    input_columns,
    naive_day,
    naive_week,
    predict_long,
    sliced,
)
from zonecast.session import Scratch, scratch_path

FORESTS = {
    "forest_no_weather": QuantileForest(weather=False),
    "forest": QuantileForest(weather=True),
}
# Training rows that make a task worth its start: a forest takes some twenty stages over its rows.
TASK_ROWS = 20_000
NAIVE = {"naive_day": naive_day, "naive_week": naive_week}


def month_starts(first: date, last: date) -> list[date]:
    """First days of the months from the month of ``first`` to ``last``."""
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    numbers = range(first.year * 12 + first.month - 1, first.year * 12 + first.month - 1 + count)
    return [date(n // 12, n % 12 + 1, 1) for n in numbers]


class FoldStore:
    """The design matrix of all labelled rows, worked out once and stored by month.

    A fold's training rows are all months before its own, so it reads a prefix of the partitions, and its test rows are one of
    them. Forests with fewer inputs slice the same vectors. Both are read in as many tasks as their rows ask for, not in one for every few months' files.
    """

    def __init__(self, known: DataFrame, zone_codes: dict[str, int], inputs: Sequence[str], work: Scratch) -> None:
        self.inputs = list(inputs)
        matrix = design_matrix(known, zone_codes, self.inputs, *KEY_COLUMNS)
        month = F.trunc("delivery_date", "month")
        path = f"{work.root}/folds"
        matrix.withColumn("month", month).hint("rebalance", "month").write.partitionBy("month").parquet(path)
        # The schema is given, as the vector's column says which of its elements are categories.
        schema = StructType([*matrix.schema.fields, StructField("month", DateType())])
        self.rows = known.sparkSession.read.schema(schema).parquet(path)

        self.counts = {r["month"]: r["n"] for r in self.rows.groupBy("month").agg(F.count("*").alias("n")).collect()}

    def months(self) -> set[date]:
        return set(self.counts)

    def before(self, month: date, inputs: Sequence[str]) -> DataFrame:
        rows = self.rows.where(F.col("month") < F.lit(month)).select("delivery_date", "target_price", "x")
        return sliced(_in_tasks(rows, sum(n for m, n in self.counts.items() if m < month)), self.inputs, inputs)

    def of(self, month: date, inputs: Sequence[str]) -> DataFrame:
        rows = self.rows.where(F.col("month") == F.lit(month)).drop("month")
        return sliced(_in_tasks(rows, self.counts.get(month, 0)), self.inputs, inputs)


def _in_tasks(rows: DataFrame, many: int) -> DataFrame:
    """``many`` rows, read in a task for each ``TASK_ROWS`` at most."""
    return rows.coalesce(max(1, -(-many // TASK_ROWS)))


def run(
    features: DataFrame,
    zone_codes: dict[str, int],
    start: date = BACKTEST_START,
    forests: dict[str, QuantileForest] | None = None,
    inputs: dict[str, list[str]] | None = None,
    parallel_folds: int = 8,
) -> DataFrame:
    """Raw predictions of every model for every month from ``start``.

    ``features`` should be a stored table. A fold is trained on all rows before its month, never on the month itself. Folds are independent Spark
    jobs, so a few run at the same time and fill each other's tails. Each writes its predictions
    before the next starts, which keeps every plan one fold long.
    """
    forests = FORESTS if forests is None else forests
    spark = features.sparkSession
    known = labelled(features)
    last = known.agg(F.max("delivery_date").alias("d")).first()["d"]
    naive = predict_long(known.where(F.col("delivery_date") >= F.lit(start)), NAIVE)
    if not forests:
        return naive
    wanted = {name: list((inputs or {}).get(name) or input_columns(forest.weather)) for name, forest in forests.items()}
    every = list(dict.fromkeys(c for columns in wanted.values() for c in columns))
    out = scratch_path(spark, "fold-predictions")
    with Scratch(spark, "fold-store") as work:
        store = FoldStore(known, zone_codes, every, work)

        def fold(job: tuple[date, str]) -> None:
            month, name = job
            fitted = forests[name].fit_matrix(store.before(month, wanted[name]), zone_codes, wanted[name])
            rows = fitted.transform_matrix(store.of(month, wanted[name]), *KEY_COLUMNS).withColumns(
                {"model": F.lit(name), "fold": F.lit(month)}
            )
            rows.select(*naive.columns).write.mode("overwrite").parquet(f"{out}/{name}/{month}")

        jobs = [(m, name) for m in month_starts(start, last) if m in store.counts for name in forests]
        with ThreadPoolExecutor(max_workers=parallel_folds) as pool:
            list(pool.map(fold, jobs))
    written = spark.read.schema(naive.schema).parquet(f"{out}/*/*")
    return naive.unionByName(written)


def backtest(
    features: DataFrame,
    zone_codes: dict[str, int],
    start: date = BACKTEST_START,
    forests: dict[str, QuantileForest] | None = None,
    inputs: dict[str, list[str]] | None = None,
    min_points: int = MIN_POINTS,
) -> DataFrame:
    """Predictions with intervals calibrated per fold from earlier folds only."""
    forests = FORESTS if forests is None else forests
    raw = run(features, zone_codes, start, forests, inputs)
    return calibrate(raw, tuple(forests), min_points=min_points)
