"""Source divergence audit over a quadtree of the group-term count matrix.

Terms are runs of letters (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, ASCII letters in lower case). Each lang keeps the V terms that at least
``LEAST_DOCS`` of its documents hold. A group is a (lang, source). With ``count`` the occurrences of a kept term in a group (or in the whole lang) and N
their sum, its price is p = 1 + floor(10^9 * (count + 1) / (N + V)), and the divergence of p from another price q is floor((p - q)^2 / q).

* ``pair``: the sum over all kept terms of a group's divergence from each other source of its lang.
* ``term``: a group's 200 terms with the greatest divergence from the whole lang, of those that it holds and over-prices.

1. Tasks count terms by (lang, source) before anything is sent; the counts meet once by (lang, term), where the kept terms, the lang's own counts and
   each term's row of the matrix are found together.
2. The matrix of a lang (groups x terms) is dealt into blocks of some ``BLOCK`` terms by the hash of the term, and, beyond ``TILE`` groups, into pairs
   of tiles of groups, so that a task's memory does not depend on the corpus.
3. A block is a K^2-tree with K = 2: each level halves the groups and the terms; quadrants without any count are zero bits, which end there. Terms stand in the
   order of the groups that hold them, so that empty quadrants are large.
4. The trees of two groups are traversed jointly, all pairs of a level at a time. Where both quadrants are empty, every term has the same
   divergence, so the pair is priced by (number of terms) x (divergence of two zero counts); only leaves where one of the two has a count are looked into.

All arithmetic is exact: counts are 64-bit, prices come from long division, and sums stay below 2^63 as prices of a group sum to 10^9 + V at most.

Defined cases: a null text, lang or source is the empty string; each row is a document. Groups without a kept term have V zero counts (and
value 0 where V is 0). A lang with one source has no pair. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import small_batches
from zonecast.session import Scratch, materialise

LEAST_DOCS, TOP = 3, 200
BLOCK, TILE = 8192, 64
# Distinct terms that a task counts before it sends them on.
COUNTED = 200_000
# Cells that are looked into at once.
CELLS = 1 << 20
SCALE = 10**9
# The bytes of a term in UTF-8, ASCII letters in lower case.
_terms = re.compile(rb"[a-z\x80-\xff]+").findall
_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)


def term_counts(docs: DataFrame) -> DataFrame:
    """(``lang``, ``source``, ``term``, ``count``, ``docs``): partial counts, each of some documents of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], Counter] = {}
        holders: dict[tuple[str, str], Counter] = {}
        size = 0

        def told() -> pa.RecordBatch:
            rows = [(*group, t.decode("utf-8", "replace"), n, holders[group][t]) for group, of in counts.items() for t, n in of.items()]
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "count", "docs"])

        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for lang, source, text in zip(langs, sources, batch.column("text"), strict=True):
                found = Counter(_terms(text.as_buffer().to_pybytes().lower()))
                group = (lang, source)
                if group not in counts:
                    counts[group], holders[group] = Counter(), Counter()
                before = len(counts[group])
                counts[group].update(found)
                holders[group].update(found.keys())
                size += len(counts[group]) - before
                if size >= COUNTED:
                    yield told()
                    counts, holders, size = {}, {}, 0
        yield told()

    rows = docs.select(_text("lang"), _text("source"), _text("text"))
    return small_batches(rows).mapInArrow(run, "lang string, source string, term string, count long, docs long")


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The matrix: (``lang``, ``source``, ``term``, ``count``, ``lang_count``, ``leads``) of the kept terms where ``count`` > 0.

    ``leads`` is 1 at one cell of each term, so that its sum counts terms.
    """
    # Dealt by (lang, term): the sum by source and the sums over sources need no further shuffle.
    parts = term_counts(docs).repartition("lang", "term")
    cells = parts.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    row = Window.partitionBy("lang", "term")
    whole = cells.select(
        "*",
        F.sum("count").over(row).alias("lang_count"),
        F.sum("docs").over(row).alias("lang_docs"),
        (F.col("source") == F.min("source").over(row)).cast("long").alias("leads"),
    )
    return whole.where(F.col("lang_docs") >= least_docs).select("lang", "source", "term", "count", "lang_count", "leads")


def group_sizes(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """Of each group: ``n`` and the lang's ``vocabulary``, ``lang_n``, and the group's ``place`` among the lang's ``groups``."""
    groups = docs.select(_text("lang"), _text("source")).distinct()
    own = cells.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.sum("leads").alias("leads"))
    none = F.lit(0).cast("long")
    lang = Window.partitionBy("lang")
    # One row a group from here on.
    return groups.join(own, ["lang", "source"], "left").select(
        "lang",
        "source",
        F.coalesce("n", none).alias("n"),
        F.coalesce(F.sum("leads").over(lang), none).alias("vocabulary"),
        F.coalesce(F.sum("n").over(lang), none).alias("lang_n"),
        (F.row_number().over(lang.orderBy("source")) - 1).alias("place"),
        F.count("*").over(lang).cast("int").alias("groups"),
    )


def price(count: Column, total: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / total), exactly, as a long; 1 where the total is 0."""
    wide = (count.cast("long") + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    total = F.greatest(total, F.lit(1))
    return F.call_function("div", wide, total.cast("decimal(19,0)")).cast("long") + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _prices(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """``price`` of 64-bit integers by long division, three digits at a time: no product exceeds 1000 x total."""
    digits, left = np.divmod(counts + 1, totals)
    for _ in range(3):
        digit, left = np.divmod(left * 1000, totals)
        digits = digits * 1000 + digit
    return digits + 1


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Quadtree:
    """A K^2-tree (K = 2) over a matrix of groups x terms, as a bitmap a level, with the counts below its leaves.

    A leaf is one group by ``width`` terms; both axes are padded to the tree's size.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, n_rows: int, n_columns: int) -> None:
        self.n_rows, self.n_columns = n_rows, n_columns
        self.depth = max(0, int(n_rows - 1).bit_length())
        self.width = -(-max(1, n_columns) // (1 << self.depth))
        side = 1 << self.depth
        self.counts = np.zeros((side, side * self.width), np.int64)
        self.counts[rows, columns] = counts
        full = np.zeros((side, side), bool)
        full[rows, columns // self.width] = True
        self.levels = [full]
        for _ in range(self.depth):
            full = full[0::2, 0::2] | full[1::2, 0::2] | full[0::2, 1::2] | full[1::2, 1::2]
            self.levels.append(full)
        self.levels.reverse()  # the root first

    def terms(self, level: int, quadrants: np.ndarray) -> np.ndarray:
        """How many real terms each column of quadrants at a level spans."""
        wide = self.width << (self.depth - level)
        return np.clip(self.n_columns - quadrants * wide, 0, wide)


def traverse(tree: Quadtree, totals: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sums of the divergence of each row in ``left`` from each row in ``right``, over all terms.

    ``left`` and ``right`` mark rows of the tree; ``totals`` has N + V of each row.
    """
    side = 1 << tree.depth
    wanted = [np.pad(x, (0, side - len(x))) for x in (left, right)]
    sides = [wanted]
    for _ in range(tree.depth):
        sides.append([x[0::2] | x[1::2] for x in sides[-1]])
    sides.reverse()
    whole = np.ones(side, np.int64)
    whole[: len(totals)] = np.maximum(totals, 1)
    zero = _prices(np.zeros(side, np.int64), whole)
    empty = np.zeros((1, 1), np.int64)  # terms that both of a pair of rows lack, by pair of quadrant rows
    i = j = t = np.zeros(1, np.int64)
    for level in range(tree.depth + 1):
        if level:
            i, j, t = (np.add.outer(2 * x, d).ravel() for x, d in ((i, [0, 0, 0, 0, 1, 1, 1, 1]), (j, [0, 0, 1, 1, 0, 0, 1, 1]), (t, [0, 1] * 4)))
            empty = np.repeat(np.repeat(empty, 2, 0), 2, 1)
            real = sides[level][0][i] & sides[level][1][j]
            i, j, t = i[real], j[real], t[real]
        some = tree.levels[level][i, t] | tree.levels[level][j, t]
        np.add.at(empty, (i[~some], j[~some]), tree.terms(level, t[~some]))
        i, j, t = i[some], j[some], t[some]
    sums = empty * _gaps(zero[:, None], zero[None, :])
    prices = _prices(tree.counts, whole[:, None])
    prices[:, tree.n_columns :] = 1  # columns of the padding differ in nothing
    leaves = prices.reshape(side, side, tree.width)
    step = max(1, CELLS // tree.width)
    for a in range(0, len(i), step):
        rows, others, at = i[a : a + step], j[a : a + step], t[a : a + step]
        np.add.at(sums, (rows, others), _gaps(leaves[rows, at], leaves[others, at]).sum(axis=1))
    return sums[: tree.n_rows, : tree.n_rows]


def _columns_by_support(rows: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """A column for each cell's term, terms that the same rows hold side by side."""
    order = np.lexsort((rows, terms))
    starts = np.flatnonzero(np.diff(terms[order], prepend=-1))
    of_term = np.split(rows[order].astype(np.int32), starts[1:]) if len(starts) else []
    rank = sorted(range(len(of_term)), key=lambda k: of_term[k].tolist())
    column = np.empty(len(of_term), np.int64)
    column[rank] = np.arange(len(of_term))
    return column[terms]


def _block_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """The sums of one block over the pairs of groups in its two tiles; rows without a term name the groups."""
    lang, block, lo, hi = rows[["lang", "block", "lo", "hi"]].iloc[0]
    named = rows[rows["term"].isna()].drop_duplicates("place").sort_values("place")
    places, totals = named["place"].to_numpy(np.int64), named["total"].to_numpy(np.int64)
    cells = rows[rows["term"].notna()]
    terms, names = pd.factorize(cells["term"])
    at = np.searchsorted(places, cells["place"].to_numpy(np.int64))
    tree = Quadtree(at, _columns_by_support(at, terms), cells["count"].to_numpy(np.int64), len(places), len(names))
    tiles = named["tile"].to_numpy()
    in_lo, in_hi = tiles == lo, tiles == hi
    sums = traverse(tree, totals, in_lo, in_hi)
    if lo != hi:
        sums = np.where(in_lo[:, None], sums, traverse(tree, totals, in_hi, in_lo))
    # Each pair of rows is told by one pair of tiles: its own.
    own = (in_lo[:, None] & in_hi[None, :]) | (in_hi[:, None] & in_lo[None, :])
    x, y = np.nonzero(own & ~np.eye(len(places), dtype=bool))
    return pd.DataFrame(
        {"lang": lang, "place": places[x].astype(np.int32), "other": places[y].astype(np.int32), "value": sums[x, y], "terms": len(names)}
    )


def pair_sums(cells: DataFrame, groups: DataFrame, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """(``lang``, ``source``, ``item``, ``value``) of each pair of groups of a lang."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("vocabulary") / block)).cast("int")
    tiles = F.ceil(F.col("groups") / tile).cast("int")
    own_tile = F.floor(F.col("place") / tile).cast("int")
    known = groups.select(
        "lang", "source", "place", (F.col("n") + F.col("vocabulary")).alias("total"), blocks.alias("blocks"), tiles.alias("tiles"), own_tile.alias("tile")
    )
    own = cells.join(known, ["lang", "source"]).select(
        "lang", F.expr("cast(pmod(xxhash64(term), blocks) as int)").alias("block"), "term", "count", "place", "total", "tile", "tiles"
    )
    # A block knows all groups of its tiles, those without a term in it too.
    names = known.select(
        "lang", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.lit(None).cast("string").alias("term"),
        F.lit(0).cast("long").alias("count"), "place", "total", "tile", "tiles",
    )
    rows = own.unionByName(names).select("*", F.explode(F.expr("sequence(0, tiles - 1)")).alias("with"))
    rows = rows.select(
        "lang", "block", F.least("tile", "with").alias("lo"), F.greatest("tile", "with").alias("hi"), "term", "count", "place", "total", "tile"
    )
    sums = rows.groupBy("lang", "block", "lo", "hi").applyInPandas(_block_sums, "lang string, place int, other int, value long, terms long")
    met = sums.groupBy("lang", "place", "other").agg(F.sum("value").alias("met"), F.sum("terms").alias("terms"))
    side = lambda place, name, zero: groups.select(
        "lang", F.col("place").alias(place), F.col("source").alias(name), price(F.lit(0), F.col("n") + F.col("vocabulary")).alias(zero), "vocabulary"
    )
    both = met.join(side("place", "source", "p"), ["lang", "place"]).join(side("other", "item", "q").drop("vocabulary"), ["lang", "other"])
    # A term that no group of the two tiles holds was in no tree: it too is priced by two zero counts.
    value = F.col("met") + (F.col("vocabulary") - F.col("terms")) * gap(F.col("p"), F.col("q"))
    return both.select("lang", "source", "item", value.alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``, as above; ``rank`` runs by value downwards, then by item."""
    with Scratch(docs.sparkSession, "divergence") as work:
        cells = work.store(kept_terms(docs, least_docs), "cells")
        groups = work.store(group_sizes(docs, cells), "groups")
        pairs = pair_sums(cells, groups, block, tile)
        sizes = groups.select("lang", "source", "n", "vocabulary", "lang_n")
        priced = cells.join(sizes, ["lang", "source"]).select(
            "lang",
            "source",
            F.col("term").alias("item"),
            price(F.col("count"), F.col("n") + F.col("vocabulary")).alias("p"),
            price(F.col("lang_count"), F.col("lang_n") + F.col("vocabulary")).alias("q"),
        )
        terms = priced.where("p > q").select("lang", "source", "item", gap(F.col("p"), F.col("q")).alias("value"))
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        ranked = [
            part.select("lang", "source", F.lit(label).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
            for label, part in (("pair", pairs), ("term", terms))
        ]
        # The limit on ranks is taken in each task before the terms of a group meet.
        return materialise(ranked[0].unionByName(ranked[1].where(F.col("rank") <= top)), "divergence")
