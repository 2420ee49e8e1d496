"""Session helpers: a local session for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "zonecast") -> SparkSession:
    """A single-JVM session for tests and bench runs; a cluster job brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a plain local session may leave it unset; it gets a temporary folder. On a cluster that would
    be a folder of one machine, so an unset value is an error there. Operators remove their own intermediates (``Scratch``);
    stored results stay, and whoever owns the folder sets their age limit.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = spark.conf.get("zonecast.scratch.dir", None)
    if not local:
        local = tempfile.mkdtemp(prefix="zonecast-")
        spark.conf.set("zonecast.scratch.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete the shuffle files of each query that ends inside the block; the setting is put back after it.

    For writes whose result is read from its files from then on. Without it, the files of every round of an iterative
    job lie on the executors' disks until the driver happens to collect garbage.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _written(df: DataFrame, path: str) -> DataFrame:
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a shared intermediate to the scratch folder and read it back.

    Used where several branches of a plan start from the same expensive rows: they are computed
    once, lineage is cut, and the files survive the loss of any executor.
    """
    return _written(df, scratch_path(df.sparkSession, name))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, through the file system that its URI names."""
    root = scratch_root(spark)
    if not path.startswith(f"{root}/"):
        raise ValueError(f"{path} is not under the scratch folder {root}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Stored intermediates of one operator, in a folder that is deleted when the block ends.

    What leaves the block must be stored outside it first (``materialise``). Until then every table stays, so a
    lost executor finds all it needs to go on.

    ``tasks``, when set, is how many tasks a step takes, and how many files a table has, at most: as many as its rows ask for, where
    the session's shuffle partitions are more than that.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, scratch_path(spark, name)
        self.tasks: int | None = None
        self._tables: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure: object) -> None:
        self._tables.clear()
        remove(self.spark, self.root)

    def narrow(self, df: DataFrame) -> DataFrame:
        """The same rows in ``tasks`` partitions at most, without a shuffle; for what is shuffled anew, mapped or written next."""
        return df if self.tasks is None else df.coalesce(self.tasks)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table to the folder and read it back."""
        path = f"{self.root}/{name}-{uuid.uuid4().hex}"
        stored = _written(self.narrow(df), path)
        self._tables[id(stored)] = (stored, path)
        return stored

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables of this folder that nothing reads any more."""
        for table in tables:
            if table is not None and id(table) in self._tables:
                remove(self.spark, self._tables.pop(id(table))[1])


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed only because nothing is there yet; any other failure must not pass for that."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
