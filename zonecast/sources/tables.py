"""Table scans and parameterised reads over the validated and modelled layers."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zonecast import schemas
from zonecast.functions.ordering import with_position
from zonecast.session import Scratch, is_missing, materialise


def scan_prices(spark: SparkSession, path: str) -> DataFrame:
    """Hive-partitioned validated prices (zone=.../month=...) with staging types."""
    df = spark.read.schema(schemas.PRICE_FILES).parquet(path)
    return df.select(
        F.col("zone").cast("string"),
        F.col("delivery_date").cast("date"),
        F.col("interval_start").cast("timestamp_ntz"),
        F.col("interval_end").cast("timestamp_ntz"),
        F.col("resolution_minutes").cast("int"),
        "price_sek_kwh",
        "price_eur_kwh",
        "eur_sek_rate",
    )


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The Parquet table at ``path``, or an empty one where nothing was written yet; other failures are raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return spark.createDataFrame([], schema)


def scan_weather_archive(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, schemas.WEATHER)


def scan_weather_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, schemas.WEATHER_SNAPSHOT)


def read_seed(spark: SparkSession, path: str, schema: str, *required: str) -> tuple[DataFrame, DataFrame]:
    """A CSV seed with a header and declared types -> (rows, rejects).

    The header must name the declared columns. A line that does not fit them (a value of another type, too few or too many fields) is
    rejected with its text, and so is one without a ``required`` column or with a key of them that an earlier one has: rejects
    are (``line``, ``reason``). The seed is read once and stored, as both sides come from the same lines.
    """
    columns = StructType.fromDDL(schema).names
    read = (
        spark.read.schema(f"{schema}, _broken string")
        .options(header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord="_broken")
        .csv(path)
    )
    lines = materialise(read, "seed")
    reason = F.when(F.col("_broken").isNotNull(), "does not fit the declared columns")
    for c in required:
        reason = reason.when(F.col(c).isNull(), f"no {c}")
    if required:
        place = F.row_number().over(Window.partitionBy(*required, F.col("_broken")).orderBy(*columns))
        lines = lines.withColumn("_place", place)
        reason = reason.when(F.col("_place") > 1, f"repeats {', '.join(required)}")
    judged = lines.withColumn("reason", reason)
    text = F.coalesce("_broken", F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    return judged.where("reason is null").select(*columns), judged.where("reason is not null").select(text.alias("line"), "reason")


def query(spark: SparkSession, sql: str, **params: object) -> DataFrame:
    """A parameterised warehouse query: ``:name`` markers bound to ``params``."""
    return spark.sql(sql, args=params)


def load_features(features: DataFrame) -> DataFrame:
    return features.orderBy("delivery_date", "zone", "hour_start")


def load_interval_prices(intervals: DataFrame, first: date, last: date) -> DataFrame:
    """Interval prices of delivery days first..last; the date filter reaches the scan."""
    return (
        intervals.where(F.col("delivery_date").between(F.lit(first), F.lit(last)))
        .select("zone", "delivery_date", "interval_start", "resolution_minutes", "price_sek_kwh")
        .orderBy("zone", "interval_start")
    )


def numbered(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """An ordered read whose order is in the rows: each has its position, so it survives any later shuffle, file or join.

    Rows are dealt and sorted by range; no task sees all of them. ``order`` should tell all rows apart.
    """
    with Scratch(df.sparkSession, "numbered") as work:
        return materialise(with_position(df, work, *order, name=name), "numbered")


def load_issued(spark: SparkSession, path: str) -> DataFrame:
    """Every issued forecast, oldest first; an empty frame of the right shape before the first."""
    log = read_or_empty(spark, path, schemas.ISSUED)
    # The log's own partition column stays behind.
    return log.select(*StructType.fromDDL(schemas.ISSUED).names).orderBy("delivery_date", "zone", "hour_start")


def driver_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")
