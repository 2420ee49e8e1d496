"""Positions and running totals in a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.session import Scratch


def _dealt(df: DataFrame, work: Scratch, order: tuple[Column | str, ...]) -> DataFrame:
    """The rows in ranges of the order, sorted inside each, with the number of their range as ``_part``.

    Stored, so that the ranges stay what they are whoever reads them next, and however often.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return work.store(placed.withColumn("_seen", F.monotonically_increasing_id()), "ranges").withColumn(
        "_part", F.shiftright("_seen", 33)
    )


def _before(dealt: DataFrame, weight: Column) -> DataFrame:
    """(``_of``, ``_before``): what all earlier ranges hold. One row a range, so the window is as long as there are tasks."""
    sums = dealt.groupBy(F.col("_part").alias("_of")).agg(F.sum(weight).alias("_sum"))
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_of", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))


def with_position(df: DataFrame, work: Scratch, *order: Column | str, name: str = "position") -> DataFrame:
    """``df`` with the zero-based position of each row in ``order``; rows equal in it are numbered in any order.

    Rows are dealt by range and sorted where they land. A row's position is its place in its range plus the rows of all ranges before.
    """
    dealt = _dealt(df, work, order)
    placed = dealt.join(_before(dealt, F.lit(1)), F.col("_part") == F.col("_of"))
    at = F.col("_before") + F.col("_seen").bitwiseAND((1 << 33) - 1)
    return placed.withColumn(name, at).drop("_seen", "_part", "_of", "_before")


def running_total(df: DataFrame, work: Scratch, weight: str, *order: Column | str, name: str = "through") -> DataFrame:
    """``df`` with the sum of ``weight`` over all rows up to and with each one in ``order``, which must tell all rows apart."""
    dealt = _dealt(df, work, order)
    here = Window.partitionBy("_part").orderBy("_seen").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("_here", F.sum(weight).over(here)).join(
        _before(dealt, F.col(weight)), F.col("_part") == F.col("_of")
    )
    return placed.withColumn(name, F.col("_before") + F.col("_here")).drop("_seen", "_part", "_of", "_before", "_here")
