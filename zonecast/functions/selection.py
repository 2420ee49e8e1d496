"""Exact order statistics of a column too long to sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.ordering import running_total
from zonecast.session import Scratch, materialise

# A bracket reaches this share of the rows to either side of the wanted rank; the sketch that
# places it is ten times finer.
_REACH = 0.001
_ACCURACY = 10000
# A bracket with more distinct values than this is cut into so many parts, of which one goes on.
_LIMIT, _PARTS = 100_000, 200


def floor_rank_values(
    df: DataFrame, value: str, shares: Sequence[float], reach: float = _REACH, limit: int = _LIMIT
) -> DataFrame:
    """(position, cut): for each share p the element at zero-based rank floor(p * n).

    A mergeable sketch brackets every wanted rank, and one scan counts what lies below each bracket and keeps the distinct
    values inside with their counts. Brackets of more than ``limit`` values are narrowed in rounds: quantiles of the
    values cut a bracket into parts, the parts are counted, and the part that holds the rank goes on. What is left is ranked
    by range partitions with prefix counts, so no task holds a bracket, however the values are spread.
    """
    rows = df.select(F.col(value).alias("v")).where(F.col("v").isNotNull())
    probes = [min(1.0, max(0.0, p + d)) for p in shares for d in (-reach, reach)]
    sketch = rows.agg(F.count("*").alias("n"), F.percentile_approx("v", probes, _ACCURACY).alias("probes")).first()
    if not sketch["n"]:
        return df.sparkSession.createDataFrame([], f"position int, cut {df.schema[value].dataType.simpleString()}")
    # A few numbers a cut are all that the driver holds.
    ranks = {i: min(sketch["n"] - 1, int(p * sketch["n"])) for i, p in enumerate(shares)}
    with Scratch(df.sparkSession, "selection") as work:
        inside = work.store(_inside(rows, sketch["probes"], len(ranks)), "inside")
        below, sizes = _sizes(inside)
        ranks = {i: r - below.get(i, 0) for i, r in ranks.items()}
        inside = inside.where(F.col("cut").isNotNull())
        while wide := [i for i, n in sizes.items() if n > limit]:
            inside, ranks = _narrowed(inside, ranks, wide, work)
            _, sizes = _sizes(inside)
        return materialise(_ranked(inside, ranks, work), "cuts")


def _inside(rows: DataFrame, probes: Sequence[float], cuts: int) -> DataFrame:
    """(``position``, ``cut``, ``here``): the values in each bracket with their counts, and one row without a value for all below it."""
    brackets = F.array(
        *[F.struct(F.lit(i).alias("position"), F.lit(probes[2 * i]).alias("low"), F.lit(probes[2 * i + 1]).alias("high")) for i in range(cuts)]
    )
    return (
        rows.select("v", F.explode(F.filter(brackets, lambda b: F.col("v") <= b["high"])).alias("b"))
        .groupBy(F.col("b.position").alias("position"), F.when(F.col("v") >= F.col("b.low"), F.col("v")).alias("cut"))
        .agg(F.count("*").alias("here"))
    )


def _sizes(inside: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Of each cut: rows below its bracket, and distinct values inside."""
    value = F.col("cut").isNotNull()
    found = inside.groupBy("position").agg(F.sum(F.when(~value, F.col("here"))).alias("below"), F.count_if(value).alias("n")).collect()
    return {r["position"]: r["below"] or 0 for r in found}, {r["position"]: r["n"] for r in found}


def _narrowed(inside: DataFrame, ranks: dict[int, int], wide: list[int], work: Scratch) -> tuple[DataFrame, dict[int, int]]:
    """The brackets with those in ``wide`` cut down to the part that holds the rank, and the ranks in what is left."""
    is_wide = F.col("position").isin(wide)
    quantiles = [k / _PARTS for k in range(1, _PARTS)]
    cuts = inside.where(is_wide).groupBy("position").agg(F.percentile_approx("cut", quantiles, _ACCURACY).alias("cuts")).collect()
    part = F.lit(0)
    for r in cuts:
        edges = F.array(*[F.lit(c) for c in sorted(set(r["cuts"]))])
        part = F.when(F.col("position") == r["position"], F.size(F.filter(edges, _less_than("cut")))).otherwise(part)
    parted = work.store(inside.withColumn("part", part), "parted")
    counts = parted.where(is_wide).groupBy("position", "part").agg(F.sum("here").alias("here")).collect()
    chosen: dict[int, int] = {}
    ranks = dict(ranks)
    for position in wide:
        for number, here in sorted((r["part"], r["here"]) for r in counts if r["position"] == position):
            if ranks[position] < here:
                chosen[position] = number
                break
            ranks[position] -= here
    keep = ~is_wide
    for position, number in chosen.items():
        keep |= (F.col("position") == position) & (F.col("part") == number)
    return work.store(parted.where(keep).drop("part"), "narrowed"), ranks


def _less_than(value: str):
    return lambda edge: edge < F.col(value)


def _ranked(inside: DataFrame, ranks: dict[int, int], work: Scratch) -> DataFrame:
    """The value of each bracket that its rank falls on."""
    totals = {r["position"]: r["here"] for r in inside.groupBy("position").agg(F.sum("here").alias("here")).collect()}
    wanted, seen = F.lit(None).cast("long"), 0
    for position in sorted(totals):
        wanted = F.when(F.col("position") == position, F.lit(seen + ranks[position])).otherwise(wanted)
        seen += totals[position]
    ordered = running_total(inside, work, "here", "position", "cut")
    hit: Column = (F.col("through") > wanted) & (F.col("through") - F.col("here") <= wanted)
    return ordered.where(hit).select("position", "cut")
