"""Ranked lexical search: a sharded inverted index in compressed blocks, searched by Block-Max MaxScore.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z count as a-z. N documents have a term, L is the
number of all their terms, n that of one document, df the number of documents that hold a term, tf its occurrences in one. A term
weighs w = floor(1000 * ln((2N + 2) / (2 df + 1))); a document's length counts m = 25 + (75 n N) div L; and its score is the sum over
the query's terms, repeats included, of w * ((10^9 tf) div (1000 tf + 8 m)), in 64-bit integers.

1. A task cuts its documents into shards of some 8 MB and inverts each: of every term the postings (document, tf, n), in blocks of
   128, as delta-coded, byte-packed columns, deflated where long. A block tells in the clear its last document and, for tf of 1, 2, 3 and more,
   the shortest document, from which follows the greatest score in it once N and L are known. The index is a table: a row a (shard, term).
2. N, L and df are sums over the index; queries meet the index by term. Queries are dealt into blocks of about 256, so what
   a shard is asked at once is bounded. Postings of one term stay in the shards they were made in, however frequent it is.
3. In each (shard, block of queries), for each query: lists are ordered by their global bound (the greatest score in any shard). With ``least`` the
   score of the tenth best document so far, the lists whose bounds sum to less are non-essential: no document that only they hold can get in. Essential lists
   are decompressed, a window of documents at a time, and scored. The candidates then go through the non-essential lists from the greatest bound on; a candidate
   is given up as soon as its score, the maximum of the list's block around it and the bounds left fall below ``least``. Only blocks
   with candidates left are decompressed.
4. A shard tells its heap of ten for each query; the heaps are merged by rank.

Bounds only spare work: results equal a full scan. A candidate that could tie with the tenth is kept, as the smaller doc_id wins.

Defined cases: a null or empty text or query has no terms and finds nothing. Rows with a null doc_id or item_id take no part. Rows
that repeat a doc_id are documents of their own; rows that repeat an item_id are one query with the terms of all. Empty tables give an empty result.
Other columns of the inputs are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import id_type, small_batches
from zonecast.session import Scratch, materialise

TOP = 10
# tf of 1, 2, 3 and 4 or more have a shortest document each; NONE says that a block has no such posting.
CLASSES, NONE = 4, -1
DEFLATED = 0x80
_terms = re.compile(rb"[0-9a-z\x80-\xff]+").findall


@dataclass(frozen=True)
class Sizes:
    """Bytes of text in a shard, postings in a block, documents scored at once, and queries asked at once (about)."""

    shard: int = 8 << 20
    postings: int = 128
    window: int = 1024
    queries: int = 256


SIZES = Sizes()


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8; bytes.lower changes A-Z alone."""
    return _terms(text.lower())


def _pack(columns: np.ndarray, greatest: int) -> bytes:
    """Columns of non-negative integers up to ``greatest`` in as few bytes each as that needs; long blocks are deflated."""
    width = next(w for w in (1, 2, 4, 8) if greatest < 1 << 8 * w)
    data = columns.astype(f"<u{width}").tobytes()
    return bytes([width]) + data if len(data) < 64 else bytes([width | DEFLATED]) + zlib.compress(data, 1)


def _unpack(block: bytes) -> np.ndarray:
    """Three rows: gaps between documents, tf, n."""
    data = zlib.decompress(block[1:]) if block[0] & DEFLATED else block[1:]
    return np.frombuffer(data, f"<u{block[0] & ~DEFLATED}").astype(np.int64).reshape(3, -1)


class _Shard:
    """Documents of one task on their way to an index shard."""

    def __init__(self) -> None:
        self.codes: defaultdict[bytes, int] = defaultdict()
        self.codes.default_factory = self.codes.__len__
        self.ids: list = []
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: object, text: bytes) -> None:
        found = terms(text)
        self.size += len(text)
        if found:
            self.ids.append(doc_id)
            self.tokens.append(np.fromiter(map(self.codes.__getitem__, found), np.int64, len(found)))

    def rows(self, postings: int) -> Iterator[tuple]:
        """(term, documents, last documents, bounds, blocks, occurrences) of each term."""
        lengths = np.array([len(t) for t in self.tokens])
        owner = np.repeat(np.arange(len(lengths)), lengths)
        keys, tf = np.unique(np.concatenate(self.tokens) * len(lengths) + owner, return_counts=True)
        term, doc = np.divmod(keys, len(lengths))
        starts = np.flatnonzero(np.diff(term, prepend=-1))
        df = np.diff(np.append(starts, len(term)))
        # Where the blocks of all terms begin and end.
        many = -(-df // postings)
        first = np.cumsum(many) - many
        cuts = np.repeat(starts, many) + postings * (np.arange(many.sum()) - np.repeat(first, many))
        ends = np.minimum(cuts + postings, np.repeat(starts + df, many))
        gaps = np.diff(doc, prepend=0)
        gaps[cuts] = doc[cuts]
        columns = np.stack([gaps, tf, lengths[doc]])
        greatest = np.maximum.reduceat(columns.max(axis=0), cuts).tolist()
        far = np.iinfo(np.int64).max
        bounds = np.empty((len(cuts), CLASSES + 1), np.int64)
        for c in range(CLASSES):
            least = np.minimum.reduceat(np.where(np.minimum(tf, CLASSES) == c + 1, columns[2], far), cuts)
            bounds[:, c] = np.where(least == far, NONE, least)
        bounds[:, CLASSES] = np.maximum.reduceat(tf, cuts)
        lasts = doc[ends - 1]
        blocks = [_pack(columns[:, a:b], most) for a, b, most in zip(cuts.tolist(), ends.tolist(), greatest, strict=True)]
        occurrences = np.add.reduceat(tf, starts).tolist()
        names = list(self.codes)
        for k, (a, n) in enumerate(zip(first.tolist(), many.tolist(), strict=True)):
            name = names[term[starts[k]]]
            yield name, int(df[k]), lasts[a : a + n], bounds[a : a + n].ravel(), blocks[a : a + n], occurrences[k]


def build_index(docs: DataFrame, sizes: Sizes = SIZES) -> DataFrame:
    """A row a (``shard``, ``term``): ``df`` and ``occurrences`` there, ``lasts``, ``bounds`` and ``blocks`` of its postings; and one row a
    shard without a term, whose ``ids`` are its documents' doc_ids in order.
    """
    kind = id_type(docs)
    names = ["shard", "term", "df", "occurrences", "lasts", "bounds", "blocks", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, made, shard, id_kind = TaskContext.get().partitionId() << 32, 0, _Shard(), None

        def told(done: _Shard) -> Iterator[pa.RecordBatch]:
            number, many = place | made, pa.list_(pa.int64())
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), many, many, pa.list_(pa.binary()), pa.list_(id_kind))
            rows: list[tuple] = [(number, None, len(done.ids), sum(map(len, done.tokens)), None, None, None, done.ids)]
            for term, df, lasts, bounds, blocks, occurrences in done.rows(sizes.postings):
                rows.append((number, term.decode("utf-8", "replace"), df, occurrences, lasts, bounds, blocks, None))
                if len(rows) == 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            id_kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                shard.add(doc_id, text.as_buffer().to_pybytes())
                if shard.size >= sizes.shard:
                    if shard.ids:
                        yield from told(shard)
                        made += 1
                    shard = _Shard()
        if shard.ids:
            yield from told(shard)

    rows = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    return small_batches(rows).mapInArrow(
        run,
        "shard long, term string, df long, occurrences long, lasts array<long>, bounds array<long>, blocks array<binary>, "
        f"ids array<{kind}>",
    )


def query_terms(items: DataFrame) -> DataFrame:
    """(``item_id``, ``term``, ``times``) of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, times = [], [], []
            for row, text in enumerate(batch.column("text")):
                for term, n in Counter(terms(text.as_buffer().to_pybytes())).items():
                    rows.append(row)
                    found.append(term.decode("utf-8", "replace"))
                    times.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(rows, pa.int64())), pa.array(found, pa.string()), pa.array(times, pa.int64())],
                names=["item_id", "term", "times"],
            )

    rows = items.where("item_id is not null and text is not null").select("item_id", "text")
    parts = rows.mapInArrow(run, f"item_id {id_type(items, 'item_id')}, term string, times long")
    return parts.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


@dataclass
class Measure:
    """Scores from the corpus counts ``n_docs`` (N) and ``n_terms`` (L)."""

    n_docs: int
    n_terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))

    def impact(self, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        m = 25 + 75 * lengths * self.n_docs // self.n_terms
        return 10**9 * tf // (1000 * tf + 8 * m)

    def block_maxima(self, bounds: np.ndarray) -> np.ndarray:
        """The greatest impact in each block: exact for tf up to 3, at most too high beyond."""
        table = bounds.reshape(-1, CLASSES + 1)
        tf = np.broadcast_to(np.arange(1, CLASSES + 1), (len(table), CLASSES)).copy()
        tf[:, -1] = table[:, -1]
        shortest = table[:, :CLASSES]
        return np.where(shortest == NONE, 0, self.impact(tf, np.maximum(shortest, 0))).max(axis=1)


class _List:
    """The postings of one term in one shard; blocks are decompressed when they are first wanted."""

    def __init__(self, measure: Measure, weight: int, ceiling: int, lasts: np.ndarray, bounds: np.ndarray, blocks: list[bytes]) -> None:
        self.measure, self.weight, self.ceiling = measure, weight, ceiling
        self.lasts, self.blocks = np.asarray(lasts), blocks
        self.maxima = measure.block_maxima(np.asarray(bounds)) * weight
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of one block."""
        if k not in self.open:
            gaps, tf, lengths = _unpack(self.blocks[k])
            self.open[k] = np.cumsum(gaps), self.weight * self.measure.impact(tf, lengths)
        return self.open[k]

    def between(self, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Documents first..last-1 with their scores, block by block."""
        for k in range(int(np.searchsorted(self.lasts, first)), min(len(self.blocks), int(np.searchsorted(self.lasts, last - 1)) + 1)):
            docs, scores = self.block(k)
            a, b = np.searchsorted(docs, (first, last))
            yield docs[a:b], scores[a:b]


def best_of_shard(lists: list[tuple[int, _List]], ids: np.ndarray, top: int = TOP, window: int = SIZES.window) -> list[tuple[int, int]]:
    """(position in ``ids``, score) of the best documents for one query: ``lists`` with how often the query has each term."""
    lists = sorted(((times * of.ceiling, times, of) for times, of in lists if of.weight > 0), key=lambda x: x[0])
    below = np.cumsum([0, *(ceiling for ceiling, _, _ in lists)]).tolist()  # below[k]: the bounds of the first k lists
    heap: list[tuple[int, int]] = []
    least = essential = 0
    for first in range(0, len(ids), window):
        last = min(len(ids), first + window)
        while essential < len(lists) and below[essential + 1] < least:
            essential += 1
        if essential == len(lists):
            break
        scores = np.zeros(last - first, np.int64)
        for _, times, of in lists[essential:]:
            for docs, gained in of.between(first, last):
                scores[docs - first] += times * gained
        docs = np.flatnonzero(scores)
        scores, docs = scores[docs], docs + first
        for k in range(essential - 1, -1, -1):
            stay = scores + below[k + 1] >= least
            docs, scores = docs[stay], scores[stay]
            if not len(docs):
                break
            _, times, of = lists[k]
            block = np.searchsorted(of.lasts, docs)
            inside = block < len(of.blocks)
            most = np.zeros(len(docs), np.int64)
            most[inside] = times * of.maxima[block[inside]]
            stay = scores + most + below[k] >= least
            docs, scores, block, inside = docs[stay], scores[stay], block[stay], inside[stay]
            for b in np.unique(block[inside]).tolist():
                own, gained = of.block(b)
                mine = np.flatnonzero(block == b)
                at = np.searchsorted(own, docs[mine])
                hit = own[at] == docs[mine]
                scores[mine[hit]] += times * gained[at[hit]]
        stay = scores >= max(least, 1)
        found = zip(docs[stay].tolist(), scores[stay].tolist(), strict=True)
        heap = sorted([*heap, *found], key=lambda x: (-x[1], ids[x[0]]))[:top]
        if len(heap) == top:
            least = heap[-1][1]
    return heap


def search(docs: DataFrame, items: DataFrame, top: int = TOP, sizes: Sizes = SIZES) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of the best documents of each item."""
    with Scratch(docs.sparkSession, "lexical-search") as work:
        return materialise(search_index(work.store(build_index(docs, sizes), "index"), items, work, top, sizes), "found")


def search_index(index: DataFrame, items: DataFrame, work: Scratch, top: int = TOP, sizes: Sizes = SIZES) -> DataFrame:
    """``search`` in an index that is stored already."""
    id_kind, item_kind = index.schema["ids"].dataType.elementType.simpleString(), id_type(items, "item_id")
    totals = index.where("term is null").agg(F.sum("df"), F.sum("occurrences")).first()
    measure = Measure(totals[0] or 0, totals[1] or 1)
    queries = work.store(query_terms(items), "queries")
    n_items = queries.select("item_id").distinct().count()
    blocks = max(1, -(-n_items // sizes.queries))
    numbered = queries.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
    asked = numbered.groupBy("part", "term").agg(F.collect_list(F.struct("item_id", "times")).alias("askers"))
    # Only lists that some query asks for leave the index.
    wanted = work.store(index.where("term is not null").join(queries.select("term").distinct(), "term", "left_semi").drop("ids"), "wanted")

    def ceilings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = [int(measure.block_maxima(np.asarray(b.values)).max()) for b in batch.column("bounds")]
            yield pa.RecordBatch.from_arrays([batch.column("term"), batch.column("df"), pa.array(most, pa.int64())], names=["term", "df", "most"])

    bounds = wanted.select("term", "df", "bounds").mapInArrow(ceilings, "term string, df long, most long")
    bounds = bounds.groupBy("term").agg(F.sum("df").alias("all_df"), F.max("most").alias("most"))
    lists = wanted.join(work.store(asked.join(bounds, "term"), "asked"), "term").select(
        "part", "shard", "term", "all_df", "most", "lasts", "bounds", "blocks", "askers", F.lit(None).cast(f"array<{id_kind}>").alias("ids")
    )
    # The documents of a shard go to each block of queries.
    shards = index.where("term is null").select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("part"),
        "shard",
        *(F.lit(None).cast(lists.schema[c].dataType).alias(c) for c in lists.columns[2:-1]),
        "ids",
    )

    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        ids = rows["ids"][rows["term"].isna()].iloc[0]
        by_item: dict[object, list[tuple[int, _List]]] = {}
        for row in rows[rows["term"].notna()].itertuples():
            weight = measure.weight(int(row.all_df))
            held = _List(measure, weight, weight * int(row.most), row.lasts, row.bounds, list(row.blocks))
            for asker in row.askers:
                by_item.setdefault(asker["item_id"], []).append((int(asker["times"]), held))
        found = [(item, ids[d], score) for item, of in by_item.items() for d, score in best_of_shard(of, ids, top, sizes.window)]
        return pd.DataFrame(found, columns=["item_id", "doc_id", "score"])

    heaps = lists.unionByName(shards).groupBy("part", "shard").applyInPandas(ask, f"item_id {item_kind}, doc_id {id_kind}, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return heaps.select("item_id", rank.alias("rank"), "doc_id", "score").where(F.col("rank") <= top)
