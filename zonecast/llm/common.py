"""Helpers shared by the text operators: reading, storing, and keeping rows by a decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import materialise

__all__ = ["WHITESPACE", "id_type", "keep_rows", "materialise", "read", "row_key", "small_batches", "word_array"]

# Rows an Arrow batch may hold at most: whole texts of up to some 100 kB are then about 50 MB.
BATCH_ROWS = 500

# The byte set that separates words.
WHITESPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder; the path is joined as text, so any URI scheme survives."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def word_array(text: Column) -> Column:
    """The words of a text: runs of anything but the six white-space bytes."""
    return F.array_remove(F.split(text, WHITESPACE), "")


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """What identifies a row where ids may be null or repeated: its id and a hash of its text."""
    return [F.col(doc_id).alias("__id"), F.xxhash64(text).alias("__text")]


def keep_rows(docs: DataFrame, decided: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``docs`` whose (id, text hash) is in ``decided`` (``__id``, ``__text``).

    All columns of ``docs`` stay as they are, whatever their names.
    """
    return docs.join(
        decided,
        docs["doc_id"].eqNullSafe(decided["__id"]) & (F.xxhash64(docs["text"]) == decided["__text"]),
        how,
    )


def id_type(df: DataFrame, column: str = "doc_id") -> str:
    return df.schema[column].dataType.simpleString()


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches lowered to ``BATCH_ROWS`` rows, as rows hold whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(key)) > BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df
