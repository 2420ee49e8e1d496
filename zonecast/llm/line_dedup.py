"""Line deduplication: range-partitioned line hashes, streamed in the order of document and position.

A line's key is the line without white space at both ends, ASCII letters in lower case. Keys of ``LEAST_CHARS`` code points or
more that ``LEAST_DOCS`` documents hold lose all their lines, but for those in the largest doc_id that holds the key.

1. Each line with a long enough key becomes a row (128-bit hash of the key, doc_id, hash of the row's text, position).
2. The rows are dealt by range over (hash, doc_id downwards, position) and sorted so within each partition. The cuts may fall inside a
   hash, so a line that a third of all documents share is spread over as many partitions as its rows need.
3. A partition is read once, as a stream. The first document of a hash keeps its lines, and the others' are dropped as soon as enough
   documents are seen; only rows of the documents before that wait. A hash that may go on in the partition before or after (the first and the
   last of each partition) sends its undecided rows on, with its first ``LEAST_DOCS`` documents.
4. These documents, a few a partition, are put together by hash and decide the undecided rows.
5. The dropped positions of a document become its keep bitmap: one bit a line, compressed. Texts are read only to find the lines and, by
   whoever wants them, to apply the bitmaps; they are never sorted.

Defined cases: a null or empty text is one empty line, which is kept. Lines end at a line feed alone. A row with a null doc_id takes no part and
keeps all its lines. Rows that repeat a doc_id are one document. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import id_type, small_batches
from zonecast.llm.wordhash import in_chunks
from zonecast.session import Scratch, materialise

LEAST_CHARS, LEAST_DOCS = 20, 3
# The white space that is stripped.
SPACE = " \t\n\v\f\r"
DROPPED, OPEN, FIRST = 0, 1, 2


def line_rows(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(``h1``, ``h2``, ``doc_id``, ``__text``, ``at``) of each line whose key is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in in_chunks(batch.column("text").to_pylist()):
                rows, positions, digests = [], [], []
                for row, text in enumerate(texts, first):
                    for at, line in enumerate(text.split("\n")):
                        key = line.strip(SPACE)
                        if len(key) >= least_chars:
                            # bytes.lower changes A-Z alone
                            key = key.encode("utf-8", "surrogatepass").lower()
                            digests.append(hashlib.blake2b(key, digest_size=16).digest())
                            rows.append(row)
                            positions.append(at)
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(halves[:, 0].copy()),
                        pa.array(halves[:, 1].copy()),
                        batch.column("doc_id").take(taken),
                        batch.column("__text").take(taken),
                        pa.array(positions, pa.int32()),
                    ],
                    names=["h1", "h2", "doc_id", "__text", "at"],
                )

    rows = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("__text"), "text")
    return small_batches(rows).mapInArrow(run, f"h1 long, h2 long, doc_id {id_type(docs)}, __text long, at int")


class _Stream:
    """The sorted rows of one partition, batch by batch.

    ``wait`` holds rows that may yet be dropped: those of the current key's documents after the first, until ``least_docs`` are seen.
    """

    def __init__(self, least_docs: int) -> None:
        self.least = least_docs
        self.key = self.doc = None
        self.rank = -1
        self.is_first = True  # the current key is the partition's first
        self.tops: list = []
        self.wait: list[pa.RecordBatch] = []

    @staticmethod
    def _marked(rows: pa.RecordBatch, kind: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), kind, np.int8)), *rows.columns], names=["kind", *rows.schema.names])

    def _firsts(self, schema: pa.Schema) -> pa.RecordBatch:
        """The current key with the first documents that hold it."""
        n = len(self.tops)
        columns = [[self.key[0]] * n, [self.key[1]] * n, self.tops, [0] * n, [0] * n]
        rows = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        return self._marked(pa.RecordBatch.from_arrays(rows, schema=schema), FIRST)

    def _closed(self, schema: pa.Schema, open_end: bool) -> Iterator[pa.RecordBatch]:
        """What the current key leaves: its rows that wait are undecided at the partition's edges and stay elsewhere."""
        if self.is_first or open_end:
            yield from (self._marked(rows, OPEN) for rows in self.wait)
            yield self._firsts(schema)
        self.wait = []
        self.is_first = False

    def feed(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        h1, h2, docs = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "doc_id"))
        new_key, new_doc = np.ones(len(h1), bool), np.ones(len(h1), bool)
        new_key[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_key[0] = self.key != (h1[0], h2[0])
        new_doc[1:] = docs[1:] != docs[:-1]
        new_doc[0] = docs[0] != self.doc
        new_doc |= new_key
        # How many documents of the same key come before each row.
        count, starts = np.cumsum(new_doc), np.flatnonzero(new_key)
        lead = starts[0] if len(starts) else len(h1)
        rank = count + self.rank
        rank[lead:] = count[lead:] - np.repeat(count[starts], np.diff(np.append(starts, len(h1))))
        begins = starts if lead == 0 else np.append(0, starts)
        ends = np.append(begins[1:], len(h1))
        enough = rank[ends - 1] >= self.least - 1
        drop = np.repeat(enough, ends - begins) & (rank > 0)
        yield self._marked(rows.filter(pa.array(drop)), DROPPED)
        if lead:  # the key of the batch before goes on
            if enough[0]:
                yield from (self._marked(waiting, DROPPED) for waiting in self.wait)
                self.wait = []
            yield from self._undecided(rows, rank, drop, 0, lead)
            self._follow(docs, new_doc, rank, 0, lead)
        for a, b in [(int(begins[i]), int(ends[i])) for i in self._kept_apart(begins, lead)]:
            if self.key is not None:
                yield from self._closed(rows.schema, False)
            self.key, self.tops = (h1[a], h2[a]), []
            yield from self._undecided(rows, rank, drop, a, b)
            self._follow(docs, new_doc, rank, a, b)
        self.doc = docs[-1]

    def _kept_apart(self, begins: np.ndarray, lead: int) -> list[int]:
        """Of the keys that begin in a batch, those that need a look: the partition's first and the batch's last; the rest is decided."""
        fresh = range(1 if lead else 0, len(begins))
        if not len(fresh):
            return []
        return sorted({fresh[0], fresh[-1]})

    def _undecided(self, rows: pa.RecordBatch, rank: np.ndarray, drop: np.ndarray, a: int, b: int) -> Iterator[pa.RecordBatch]:
        part, left = rows.slice(a, b - a), ~drop[a:b]
        if self.is_first:  # a larger document may be in the partition before
            yield self._marked(part.filter(pa.array(left & (rank[a:b] == 0))), OPEN)
        waiting = part.filter(pa.array(left & (rank[a:b] > 0)))
        if len(waiting):
            self.wait.append(waiting)

    def _follow(self, docs: np.ndarray, new_doc: np.ndarray, rank: np.ndarray, a: int, b: int) -> None:
        room = self.least - len(self.tops)
        self.tops += docs[a:b][new_doc[a:b]][:room].tolist()
        self.rank = int(rank[b - 1])

    def end(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.key is not None:
            yield from self._closed(schema, True)


def dropped_lines(rows: DataFrame, work: Scratch, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(``doc_id``, ``__text``, ``at``) of the lines to drop, of rows as ``line_rows`` gives them, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, schema = _Stream(least_docs), None
        for batch in batches:
            if len(batch):
                schema = batch.schema
                yield from (b for b in stream.feed(batch) if len(b))
        if schema is not None:
            yield from (b for b in stream.end(schema) if len(b))

    kind = id_type(rows)
    order = ("h1", "h2", F.desc("doc_id"), "__text", "at")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    told = work.store(
        ordered.mapInArrow(run, f"kind byte, h1 long, h2 long, doc_id {kind}, __text long, at int"), "told-lines"
    )
    # A few rows a partition: how many documents hold the keys at its edges, and the largest of them.
    edges = told.where(F.col("kind") == FIRST).groupBy("h1", "h2").agg(
        F.max("doc_id").alias("keeper"), F.count_distinct("doc_id").alias("docs")
    )
    undecided = told.where(F.col("kind") == OPEN).join(edges.where(F.col("docs") >= least_docs), ["h1", "h2"])
    return (
        told.where(F.col("kind") == DROPPED)
        .select("doc_id", "__text", "at")
        .unionByName(undecided.where("doc_id < keeper").select("doc_id", "__text", "at"))
    )


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Of each row: ``doc_id``, a hash of its text, ``n_lines``, ``n_dropped``, and ``keep``: one bit a line (1: kept), compressed."""
    with Scratch(docs.sparkSession, "line-dedup") as work:
        dropped = dropped_lines(work.store(line_rows(docs, least_chars), "lines"), work, least_docs)
        of_document = dropped.groupBy(F.col("doc_id").alias("__id"), F.col("__text").alias("__of")).agg(
            F.collect_set("at").alias("dropped")
        )
        text = F.coalesce("text", F.lit(""))
        sizes = docs.select("doc_id", F.xxhash64("text").alias("__text"), F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"))
        rows = sizes.join(of_document, (F.col("doc_id") == F.col("__id")) & (F.col("__text") == F.col("__of")), "left")
        packed = rows.select("doc_id", "__text", "n_lines", "dropped").mapInArrow(
            _pack, f"doc_id {id_type(docs)}, __text long, n_lines long, n_dropped long, keep binary"
        )
        return materialise(packed, "keep-bitmaps")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, bitmaps = [], []
        for n, dropped in zip(batch.column("n_lines").to_pylist(), batch.column("dropped"), strict=True):
            keep = np.ones(n, bool)
            if dropped.is_valid:
                keep[np.asarray(dropped.values)] = False
            counts.append(n - int(keep.sum()))
            bitmaps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "__text", "n_lines")), pa.array(counts, pa.int64()), pa.array(bitmaps, pa.binary())],
            names=["doc_id", "__text", "n_lines", "n_dropped", "keep"],
        )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Of each row: ``doc_id``, ``n_lines``, ``n_dropped``, ``kept``: the text's kept lines, joined by line feeds (null: empty)."""
    marks = bitmaps.where("n_dropped > 0").dropDuplicates(["doc_id", "__text"])
    marks = marks.select(F.col("doc_id").alias("__id"), "__text", "n_dropped", "keep")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("__hash"))
    rows = rows.join(marks, (F.col("doc_id") == F.col("__id")) & (F.col("__hash") == F.col("__text")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, kept = [], []
            for text, keep in zip(batch.column("text"), batch.column("keep"), strict=True):
                text = text.as_py()
                sizes.append(text.count("\n") + 1)
                if keep.is_valid:
                    stays = np.unpackbits(np.frombuffer(zlib.decompress(keep.as_py()), np.uint8), count=sizes[-1])
                    text = "\n".join([line for line, stay in zip(text.split("\n"), stays.tolist(), strict=True) if stay])
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), batch.column("n_dropped"), pa.array(kept, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept"],
            )

    return small_batches(rows.select("doc_id", "text", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "keep")).mapInArrow(
        run, f"doc_id {id_type(docs)}, n_lines long, n_dropped long, kept string"
    )


def deduplicate_lines(docs: DataFrame) -> DataFrame:
    """``apply_bitmaps`` with the bitmaps of the documents themselves."""
    return apply_bitmaps(docs, keep_bitmaps(docs))


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
