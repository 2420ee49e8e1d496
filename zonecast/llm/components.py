"""Connected components of a graph whose links are a distributed table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import id_type
from zonecast.session import Scratch, materialise

# Links, repeats included, that one task joins at once: a megabyte or two, whatever the size of the input. More go by rounds.
AT_ONCE = 1 << 16


def components(links: DataFrame, rounds: int = 60, store: Callable[[DataFrame, str], DataFrame] = materialise) -> DataFrame:
    """(``id``, ``component``): the smallest id that each linked id reaches, as a stored table.

    ``links`` has columns ``a`` and ``b`` and should be stored. At most ``AT_ONCE`` of them are joined in one task, as a round of so few would
    only be shuffles of next to nothing. Otherwise rounds alternate between hanging every larger neighbour of
    an id on its smallest neighbour and hanging smaller ones so, until every id hangs on one other that hangs on none: its component. Each round is two aggregations, which combine before they shuffle, and two
    joins against one row per id, so a hub's links are spread by splitting the skewed side. A round's
    links are a stored table, deleted when the next one is.
    """
    links = links.where("a <> b")
    if links.count() <= AT_ONCE:
        return store(_closed(links), "components")
    with Scratch(links.sparkSession, "components") as work:
        links = work.store(
            links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
            "links",
        )
        for _ in range(rounds):
            both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            half = _hang(both, F.col("b") > F.col("a"), work)
            work.drop(links)
            links = _hang(half, F.lit(True), work)
            work.drop(half)
            if _settled(links):
                break
        else:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
        found = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
        found = found.unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
        return store(found, "components")


def _closed(links: DataFrame) -> DataFrame:
    """(``id``, ``component``) of a few links, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if len(batch)]
        if not held:
            return
        ends = pa.Table.from_batches(held)
        a, b = (ends.column(c).to_numpy() for c in ("a", "b"))
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b = at[: len(a)], at[len(a) :]
        least, before = np.arange(len(ids)), None
        # Each id, and the one that it hangs on, takes the least across a link, then that of the one it hangs on.
        while before is None or (least != before).any():
            before, least = least, least.copy()
            for x, y in ((a, b), (b, a)):
                np.minimum.at(least, x, before[y])
                np.minimum.at(least, before[x], before[y])
            least = least[least]
        kind = ends.schema.field("a").type
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(ids[least], kind)], names=["id", "component"])

    kind = id_type(links, "a")
    return links.select("a", "b").coalesce(1).mapInArrow(run, f"id {kind}, component {kind}")


def _hang(links: DataFrame, moved: object, work: Scratch) -> DataFrame:
    """Links each neighbour ``b`` of ``a`` where ``moved`` holds, and ``a`` itself, to the least of all."""
    # One aggregate, read by the join and by the rows of its own; it is not stored, as Spark reuses its exchange.
    least = links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")).withColumnRenamed("a", "of")
    joined = links.join(least, links["a"] == least["of"])
    neighbours = joined.where(moved).select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select(F.col("of").alias("a"), F.col("least").alias("b"))
    return work.store(neighbours.unionByName(own).where("a <> b").distinct(), "links")


def _settled(links: DataFrame) -> bool:
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    moving = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return moving.where("up > 1 or (up > 0 and down > 0)").isEmpty()
