"""Output shaping shared by the queries: one integer type, doubles rounded to six places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Means of two-decimal values often end exactly on a five in the seventh place. A nudge far below
# the last digit kept makes such ties round up whatever order the values were added in.
NUDGE = 1e-9


def rounded(value: Column | str) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    return F.round(c + F.lit(NUDGE), 6)


def six(*names: str) -> list[Column]:
    return [rounded(n).alias(n) for n in names]


def big(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]
