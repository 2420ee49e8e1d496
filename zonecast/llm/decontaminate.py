"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits in lower case, so that punctuation and case hide nothing.

1. Every run of ``SEED`` words of the benchmark is a seed. A document is reduced to its stretches of seeds: a
   match of at least ``SEED`` words consists of seeds throughout, so nothing else of the document matters.
   A bitmap of fixed size (``BITMAP_BYTES``) drops the other stretches where the document is read; it may let
   too much pass, never too little.
2. Stretches and items meet in a join on the seeds they share, which are counted by pair. A pair with too few of the item's seeds to reach the threshold
   ends there, so a phrase that many documents share makes no tiling.
3. Each (document, item) pair is tiled: the longest match of unmarked words is marked in both, again and again,
   until no match of ``SEED`` words is left. Matches are found by running Karp-Rabin hashes: matching runs of ``SEED`` words
   are extended by doubled hashes, skipping what lies inside a match already extended, and hash hits are compared word by word.
4. A document is contaminated by an item if its tiles cover at least ``threshold`` of the item's words, in
   whatever order the passages stand.

Defined cases: a null or empty document or item has no words and matches nothing; nor does an item of fewer than
``SEED`` words, which identifies nothing. A null doc_id or item_id takes no part. Rows that repeat an id are one document or item with several
texts; the best coverage counts, and ``clean`` takes out the contaminated text alone. Empty tables give an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import id_type, keep_rows, small_batches
from zonecast.llm.wordhash import U, Words, in_chunks, runs
from zonecast.session import Scratch, materialise

SEED = 5
THRESHOLD = 0.5
SLOT_BITS = 22
BITMAP_BYTES = 1 << (SLOT_BITS - 3)
_PRIME = (1 << 61) - 1
_between = re.compile(r"[\W_]+")


def plain(text: str | None) -> str:
    """The words of a text in lower case, with one space between."""
    return _between.sub(" ", (text or "").lower())


def _slots(seeds: np.ndarray) -> np.ndarray:
    return (seeds >> U(64 - SLOT_BITS)).astype(np.int64)


def item_seeds(items: DataFrame) -> DataFrame:
    """(``item_id``, ``words`` as one string, ``n_words``, ``seeds`` and how many ``times`` each) of the items with ``SEED`` words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cleaned = [plain(t) for t in batch.column("text").to_pylist()]
            sizes, seeds, times = [], [], []
            for _, texts in in_chunks(cleaned):
                words = Words(texts)
                all_seeds = runs(words.hashes, SEED)
                for a, b in words:
                    own, many = np.unique(all_seeds[a : max(a, b - SEED + 1)], return_counts=True)
                    sizes.append(b - a)
                    seeds.append(own.view(np.int64))
                    times.append(many)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(cleaned), pa.array(sizes, pa.int64()), pa.array(seeds, lists), pa.array(times, lists)],
                names=["item_id", "words", "n_words", "seeds", "times"],
            )

    rows = items.select("item_id", "text").where("item_id is not null")
    found = small_batches(rows).mapInArrow(
        run,
        f"item_id {id_type(items, 'item_id')}, words string, n_words long, seeds array<long>, times array<long>"
    )
    return found.where(F.size("seeds") > 0)


def _bitmap(seeds: DataFrame) -> bytes:
    """A bit for each of 2 ** ``SLOT_BITS`` slots: whether a seed falls there. So many rows at most are gathered."""
    slots = seeds.select(F.shiftrightunsigned("seed", 64 - SLOT_BITS).cast("int").alias("slot")).distinct()
    marks = np.zeros(1 << SLOT_BITS, bool)
    marks[slots.toArrow().column("slot").to_numpy()] = True
    return np.packbits(marks).tobytes()


def stretches(docs: DataFrame, bitmap: bytes) -> DataFrame:
    """(``doc_id``, text hash, ``stretches`` of words, ``seeds``) of the documents that touch the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
        for batch in batches:
            rows, parts, seeds = [], [], []
            texts = batch.column("text").to_pylist()
            for at, run_of in in_chunks(texts):
                words = Words([plain(t) for t in run_of])
                all_seeds = runs(words.hashes, SEED)
                hits = marks[_slots(all_seeds)]
                for k, (first, last) in enumerate(words):
                    hit = np.flatnonzero(hits[first : max(first, last - SEED + 1)]) + first
                    if not len(hit):
                        continue
                    breaks = np.flatnonzero(np.diff(hit) > 1)
                    begins, ends = hit[np.append(0, breaks + 1)], hit[np.append(breaks, len(hit) - 1)] + SEED - 1
                    cut = zip(words.starts[begins].tolist(), words.ends[ends].tolist(), strict=True)
                    rows.append(at + k)
                    parts.append([words.data[a:b].decode("utf-8", "replace") for a, b in cut])
                    seeds.append(np.unique(all_seeds[hit]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    batch.column("__text").take(pa.array(rows, pa.int64())),
                    pa.array(parts, pa.list_(pa.string())),
                    pa.array(seeds, pa.list_(pa.int64())),
                ],
                names=["doc_id", "__text", "stretches", "seeds"],
            )

    rows = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("__text"), "text")
    return small_batches(rows).mapInArrow(
        run, f"doc_id {id_type(docs)}, __text long, stretches array<string>, seeds array<long>"
    )


def _fingerprints(words: list[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """Running hashes of each ``length`` unmarked words in a row: (hash, position)."""
    lead = pow(1_000_003, length - 1, _PRIME)
    value = held = 0
    for i, word in enumerate(words):
        if not free[i]:
            value = held = 0
            continue
        if held == length:
            value -= words[i - length] * lead
            held -= 1
        value = (value * 1_000_003 + word) % _PRIME
        held += 1
        if held == length:
            yield value, i - length + 1


class _Runs:
    """Hashes of the runs of 1, 2, 4, ... words that start at each position."""

    def __init__(self, words: list[int]) -> None:
        self.levels = [words]
        while 2 ** len(self.levels) <= len(words):
            below, half = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append([(x * 1_000_003 + y + len(self.levels)) % _PRIME for x, y in zip(below, below[half:], strict=False)])


def _shared_run(a: _Runs, i: int, b: _Runs, j: int) -> int:
    """How many words two sequences share from two positions on, by doubled hashes; what they say is compared word by word."""
    k = 0
    for level in range(min(len(a.levels), len(b.levels)) - 1, -1, -1):
        x, y = a.levels[level], b.levels[level]
        while i + k < len(x) and j + k < len(y) and x[i + k] == y[j + k]:
            k += 1 << level
    x, y = a.levels[0], b.levels[0]
    if x[i : i + k] != y[j : j + k]:
        k = next(n for n in range(k) if x[i + n] != y[j + n])
    return k


def _maximal_matches(a: list[int], b: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, position in a, position in b) of the matches of ``least`` words or more that no neighbouring word extends."""
    table: dict[int, list[int]] = defaultdict(list)
    for value, i in _fingerprints(a, [True] * len(a), least):
        table[value].append(i)
    starts = {value: np.array(positions) for value, positions in table.items()}
    before = np.array([-1, *a])  # the word before each position
    runs_a, runs_b = _Runs(a), _Runs(b)
    for value, j in _fingerprints(b, [c != 0 for c in b], least):
        positions = starts.get(value)
        if positions is None:
            continue
        # Inside a match that began earlier there is nothing new.
        fresh = positions if j == 0 else positions[before[positions] != b[j - 1]]
        for i in fresh.tolist():
            k = _shared_run(runs_a, i, runs_b, j)
            if k >= least:
                yield k, i, j


def tile(item: list[str], parts: list[list[str]], least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (position in item, position in parts joined by a gap, length) of each tile.

    The longest match of unmarked words is marked, of equals the one that is first in the item, then in the parts, until none of ``least`` words is
    left. A match that a tile has cut comes back as what is left of it.
    """
    codes: dict[str, int] = defaultdict(lambda: len(codes) + 1)
    a = [codes[w] for w in item]
    b: list[int] = []
    for part in parts:
        b += [codes[w] for w in part]
        b.append(0)  # a gap, which no item word equals
    taken_a, taken_b = bytearray(len(a)), bytearray(len(b))
    heap = [(-k, i, j) for k, i, j in _maximal_matches(a, b, least)]
    heapq.heapify(heap)
    tiles, free = [], len(a)
    while heap and free >= least:
        k, i, j = heapq.heappop(heap)
        k = -k
        if taken_a.find(1, i, i + k) < 0 and taken_b.find(1, j, j + k) < 0:
            taken_a[i : i + k] = taken_b[j : j + k] = b"\1" * k
            tiles.append((i, j, k))
            free -= k
            continue
        marks = bytes(x | y for x, y in zip(taken_a[i : i + k], taken_b[j : j + k], strict=True))
        at = 0
        for run in marks.split(b"\1"):
            if len(run) >= least:
                heapq.heappush(heap, (-len(run), i + at, j + at))
            at += len(run) + 1
    return tiles


def _coverage(docs: DataFrame, items: DataFrame, threshold: float, work: Scratch) -> DataFrame:
    """``coverage`` with the hash of the document's text."""
    known = work.store(item_seeds(items), "benchmark-items")
    seeds = known.select("item_id", "n_words", F.explode(F.arrays_zip("seeds", "times")).alias("s"))
    seeds = seeds.select("item_id", "n_words", F.col("s.seeds").alias("seed"), F.col("s.times").alias("times"))
    own = work.store(stretches(docs, _bitmap(seeds)), "stretches")
    doc_seeds = own.select("doc_id", "__text", F.explode("seeds").alias("own_seed")).distinct()
    pairs = doc_seeds.join(seeds, F.col("own_seed") == F.col("seed")).groupBy("doc_id", "__text", "item_id").agg(
        F.sum("times").alias("shared"), F.first("n_words").alias("n_words")
    )
    # A tile of k words, 5 at least, holds k - 4 of the item's seeds: s seeds cover 5 s words at most.
    likely = pairs.where(F.col("shared") * SEED >= F.lit(threshold) * F.col("n_words")).select("doc_id", "__text", "item_id")
    likely = work.store(likely, "pairs")
    both = likely.join(known.select(F.col("item_id").alias("__item"), "words"), F.col("item_id") == F.col("__item")).join(
        own.select(F.col("doc_id").alias("__doc"), F.col("__text").alias("__of"), "stretches").dropDuplicates(["__doc", "__of"]),
        (F.col("doc_id") == F.col("__doc")) & (F.col("__text") == F.col("__of")),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, covered, sizes = [], [], []
            for words, parts in zip(batch.column("words").to_pylist(), batch.column("stretches").to_pylist(), strict=True):
                item = words.split()
                tiles = tile(item, [p.split() for p in parts])
                counts.append(len(tiles))
                covered.append(sum(k for *_, k in tiles))
                sizes.append(len(item))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "__text", "item_id")),
                    *(pa.array(x, pa.int64()) for x in (counts, covered, sizes)),
                ],
                names=["doc_id", "__text", "item_id", "n_tiles", "n_covered", "n_item_words"],
            )

    tiled = both.select("doc_id", "__text", "item_id", "words", "stretches").mapInArrow(
        run,
        f"doc_id {id_type(docs)}, __text long, item_id {id_type(items, 'item_id')}, n_tiles long, n_covered long, n_item_words long",
    )
    return tiled.withColumn("coverage", F.col("n_covered") / F.col("n_item_words")).where(F.col("coverage") >= threshold)


def coverage(docs: DataFrame, items: DataFrame, threshold: float = 0.0) -> DataFrame:
    """(``doc_id``, ``item_id``, ``n_tiles``, ``n_covered``, ``n_item_words``, ``coverage``) of pairs that share a seed and reach the threshold.

    One row a pair: of several texts of a document or an item, those that cover most.
    """
    columns = ["coverage", "n_covered", "n_tiles", "n_item_words"]
    with Scratch(docs.sparkSession, "decontamination") as work:
        best = _coverage(docs, items, threshold, work).groupBy("doc_id", "item_id").agg(F.max(F.struct(*columns)).alias("best"))
        found = best.select("doc_id", "item_id", "best.n_tiles", "best.n_covered", "best.n_item_words", "best.coverage")
        return materialise(found, "coverage")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs whose coverage is at least ``threshold``, with ``contaminated`` true."""
    return coverage(docs, items, threshold).withColumn("contaminated", F.lit(True))


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that no item contaminates; all columns stay. Another text with the id of a contaminated one stays too."""
    with Scratch(docs.sparkSession, "decontamination") as work:
        found = _coverage(docs, items, threshold, work).select(F.col("doc_id").alias("__id"), "__text").distinct()
        found = materialise(found, "contaminated")
    return keep_rows(docs, found, "left_anti")
