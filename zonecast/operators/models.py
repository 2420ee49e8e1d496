"""Forecast models: two seasonal naive baselines and a quantile forest on Spark ML."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.config import CALENDAR_INPUTS, PRICE_INPUTS, QCOLS, QUANTILES, WEATHER_INPUTS
from zonecast.functions.clock import month_start
from zonecast.functions.numeric import ordered

KEY_COLUMNS = ("zone", "delivery_date", "hour_start", "hour_local", "target_price")

Quantiles = tuple[Column, Column, Column]
Predictor = Callable[[], Quantiles]


def naive_day() -> Quantiles:
    """Tomorrow looks like today: the same local hour of the day before, else its mean."""
    value = F.coalesce("lag_1d", "prev_day_mean")
    return value, value, value


def naive_week() -> Quantiles:
    """Tomorrow looks like the same weekday last week, else like the last week."""
    value = F.coalesce("lag_7d", "prev_week_mean")
    return value, value, value


def predict_long(rows: DataFrame, models: dict[str, Predictor], *keep: str) -> DataFrame:
    """One row per input row and model, in a single pass over the input.

    ``fold`` is the month a row belongs to.
    """
    entries = [
        F.struct(
            F.lit(name).alias("model"),
            *[q.cast("double").alias(c) for q, c in zip(predictor(), QCOLS, strict=True)],
        )
        for name, predictor in models.items()
    ]
    return rows.select(
        *(keep or KEY_COLUMNS),
        month_start("delivery_date").alias("fold"),
        F.inline(F.array(*entries)),
    )


# Inputs that may be missing, and what stands in for them.
_FALLBACKS = {"lag_1d": "prev_day_mean", "lag_2d": "prev_day_mean", "lag_7d": "prev_week_mean"}


def input_columns(
    weather: bool = True,
    price: Sequence[str] = PRICE_INPUTS,
    covariates: Sequence[str] = WEATHER_INPUTS,
) -> list[str]:
    return [*CALENDAR_INPUTS, *price, *(covariates if weather else ())]


def design_matrix(
    rows: DataFrame, zone_codes: dict[str, int], inputs: Sequence[str], *keep: str
) -> DataFrame:
    """Numeric inputs with the zone as an integer category (first element of ``x``).

    Trees in Spark ML take no nulls: a missing lag falls back to the matching mean, anything
    else to 0, and every input that can be missing gets a flag the trees can split on.
    """
    code = F.create_map(*[F.lit(v) for pair in zone_codes.items() for v in pair])
    nullable = [c for c in inputs if c not in CALENDAR_INPUTS]
    filled = [
        F.coalesce(
            F.col(c).cast("double"),
            *([F.col(_FALLBACKS[c]).cast("double")] if _FALLBACKS.get(c) in inputs else []),
            F.lit(0.0),
        ).alias(f"x_{c}")
        for c in inputs
    ]
    flags = [F.col(c).isNull().cast("double").alias(f"m_{c}") for c in nullable]
    # Nominal metadata makes the trees split the zone by category, not by size of its code.
    zone = F.element_at(code, F.col("zone")).cast("double").alias(
        "x_zone", metadata={"ml_attr": {"type": "nominal", "name": "x_zone", "vals": list(zone_codes)}}
    )
    names = ["x_zone", *[f"x_{c}" for c in inputs], *[f"m_{c}" for c in nullable]]
    wide = rows.select(*keep, zone, *filled, *flags)
    return VectorAssembler(inputCols=names, outputCol="x").transform(wide).select(*keep, "x")


def sliced(matrix: DataFrame, inputs: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """A matrix over ``inputs`` with ``x`` cut down to what a matrix over ``wanted``, some of them, would hold."""
    names = [f"x_{c}" for c in ("zone", *inputs)] + [f"m_{c}" for c in inputs if c not in CALENDAR_INPUTS]
    kept = [f"x_{c}" for c in ("zone", *wanted)] + [f"m_{c}" for c in wanted if c not in CALENDAR_INPUTS]
    if names == kept:
        return matrix
    slicer = VectorSlicer(inputCol="x", outputCol="_x", indices=[names.index(c) for c in kept])
    return slicer.transform(matrix).drop("x").withColumnRenamed("_x", "x")


def matrix_names(inputs: Sequence[str]) -> list[str]:
    """The input behind each element of ``x``; a missing flag stands for its input."""
    return ["zone", *inputs, *[c for c in inputs if c not in CALENDAR_INPUTS]]


@dataclass(frozen=True)
class QuantileForest:
    """A random forest whose leaves answer with quantiles of the training labels they hold.

    Spark ML grows the trees; one aggregation then turns the training rows of every leaf into
    the three quantiles. One fit serves all quantiles, and averaging over trees keeps them in
    order. The leaf table has at most ``trees * 2**depth`` rows whatever the training size, so it
    travels as one array and a prediction is a lookup inside the row: no join, no shuffle.
    """

    weather: bool = True
    trees: int = 20
    depth: int = 7
    min_leaf: int = 10
    seed: int = 7
    quantiles: tuple[float, ...] = QUANTILES

    def fit(
        self, rows: DataFrame, zone_codes: dict[str, int], inputs: Sequence[str] | None = None
    ) -> FittedForest:
        inputs = list(inputs or input_columns(self.weather))
        return self.fit_matrix(design_matrix(rows, zone_codes, inputs, "target_price"), zone_codes, inputs)

    def fit_matrix(self, train: DataFrame, zone_codes: dict[str, int], inputs: Sequence[str]) -> FittedForest:
        """``fit`` on a design matrix that is there already (``x``, ``target_price``)."""
        forest = RandomForestRegressor(
            featuresCol="x",
            labelCol="target_price",
            leafCol="leaf",
            numTrees=self.trees,
            maxDepth=self.depth,
            minInstancesPerNode=self.min_leaf,
            subsamplingRate=0.8,
            featureSubsetStrategy="onethird",
            seed=self.seed,
            maxBins=max(32, len(zone_codes)),
        )
        model = forest.fit(train)
        counted = (
            model.transform(train)
            .select(
                "target_price", F.posexplode(vector_to_array("leaf")).alias("tree", "leaf")
            )
            .groupBy("tree", F.col("leaf").cast("int").alias("leaf"), "target_price")
            .agg(F.count("*").alias("here"))
        )
        # Exact whatever a leaf holds: its values are counted first, then ranked by running totals.
        leaf = Window.partitionBy("tree", "leaf")
        ranked = counted.withColumns(
            {"through": F.sum("here").over(leaf.orderBy("target_price")), "total": F.sum("here").over(leaf)}
        )
        cuts = [
            F.min(F.when(F.col("through") >= F.ceil(F.lit(q) * F.col("total")), F.col("target_price")))
            for q in self.quantiles
        ]
        leaves = ranked.groupBy("tree", "leaf").agg(F.array(*cuts).alias("q"))
        table = {(r["tree"], r["leaf"]): r["q"] for r in leaves.collect()}
        return FittedForest(self, model, dict(zone_codes), list(inputs), table)


@dataclass(frozen=True)
class FittedForest:
    spec: QuantileForest
    model: RandomForestRegressionModel
    zone_codes: dict[str, int]
    inputs: list[str]
    table: dict[tuple[int, int], list[float]]

    def transform(self, rows: DataFrame, *keep: str) -> DataFrame:
        """``keep`` columns plus q10, q50 and q90."""
        return self.transform_matrix(design_matrix(rows, self.zone_codes, self.inputs, *keep), *keep)

    def transform_matrix(self, matrix: DataFrame, *keep: str) -> DataFrame:
        """``transform`` of a design matrix that is there already."""
        scored = self.model.transform(matrix).select(*keep, vector_to_array("leaf").alias("leaf"))
        sizes = [
            1 + max((leaf for t, leaf in self.table if t == tree), default=0)
            for tree in range(self.model.getNumTrees)
        ]
        # [tree][leaf][quantile]; the text folds to one literal when the plan is optimised.
        nested = [
            [self.table.get((tree, leaf)) for leaf in range(size)] for tree, size in enumerate(sizes)
        ]
        values = F.from_json(F.lit(json.dumps(nested)), "array<array<array<double>>>")
        found = F.transform("leaf", lambda leaf, t: F.get(F.get(values, t), leaf.cast("int")))
        scored = scored.withColumn("found", found)

        def over_trees(i: int) -> Column:
            total = F.aggregate("found", F.lit(0.0), lambda acc, q: acc + F.get(q, F.lit(i)))
            return total / len(sizes)

        out = [over_trees(i) for i in range(len(self.spec.quantiles))]
        # A single quantile stands for all three.
        three = out * 3 if len(out) == 1 else ordered(*out)
        return scored.select(*keep, *[q.alias(c) for q, c in zip(three, QCOLS, strict=True)])

    def importance(self) -> DataFrame:
        """Share of each input in the forest's splits, largest first, its missing flag included."""
        spark = SparkSession.active()
        shares: dict[str, float] = {}
        for name, value in zip(
            matrix_names(self.inputs), self.model.featureImportances.toArray().tolist(), strict=True
        ):
            shares[name] = shares.get(name, 0.0) + value
        return spark.createDataFrame(
            list(shares.items()), "input string, importance double"
        ).orderBy(F.desc("importance"), "input")
