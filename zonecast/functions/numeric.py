"""Small numeric expressions: losses, order repair, shares and output cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pinball(actual: Column, predicted: Column, q: float) -> Column:
    """Quantile loss of one prediction."""
    diff = actual - predicted
    return F.greatest(F.lit(q) * diff, F.lit(q - 1) * diff)


def inside(actual: Column, low: Column, high: Column) -> Column:
    """Inclusive interval hit as 1.0 / 0.0."""
    return actual.between(low, high).cast("double")


def conformal_score(actual: Column, low: Column, high: Column) -> Column:
    """How far the actual fell outside the interval; negative when inside."""
    return F.greatest(low - actual, actual - high)


def ordered(*values: Column) -> list[Column]:
    """The same values in ascending order, so that quantiles never cross."""
    arr = F.array_sort(F.array(*values))
    return [F.get(arr, F.lit(i)) for i in range(len(values))]


def share(part: Column, whole: Column) -> Column:
    """part / whole, and 0 when there is nothing to share."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / F.nullif(whole, F.lit(0.0)))


def finite(value: Column) -> Column:
    """NaN and infinities to null."""
    return F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), None).otherwise(value)


def json_ready(df: DataFrame, digits: int = 5) -> DataFrame:
    """Columns as a JSON report shows them: no NaN, rounded floats, ISO dates and times."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(finite(c.cast("double")), digits)
        elif isinstance(field.dataType, T.TimestampNTZType):
            fraction = F.date_format(c, "SSSSSS")
            c = F.concat(
                F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
                F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
                F.lit("+00:00"),
            )
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(field.name))
    return df.select(out)
