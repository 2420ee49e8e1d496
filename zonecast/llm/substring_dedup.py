"""Substring deduplication with prefix-partitioned suffix trees over words.

Each word position starts a suffix. The trees are cut at depth ``WINDOW`` (50 words), as deeper nodes change nothing; a word is its 64-bit hash.

1. Documents with equal word sequences are one; the smallest doc_id stands for them, and the others are
   repeats throughout.
2. A suffix belongs to the group of a run of ``PREFIX`` (20) words among its first 50: of the 31 such runs the one
   with the smallest fingerprint, so that equal suffixes meet in the same group and neighbours share theirs. About
   one run in sixteen is ever chosen. Groups are counted first; one of a single document has no internal node and ends there.
3. Prefixes have two lengths. A group of at most ``GROUP`` suffixes fits in a task: its suffixes are sent as stretches of words, and its tree is built there (the
   suffixes in order, with the words that each shares with the next). A larger group's prefix is lengthened to the full 50 words: its suffixes are then equal as
   far as the tree goes, so each such group is one node, of which only the smallest doc_id is wanted, an aggregate that combines before the shuffle. What is
   dealt is a row for each window of a part (the texts that a task reads at once), with all places where the part has it; the window's smallest doc_id
   goes back to the parts, which join their places to runs. Neither a prefix nor a window that a third of the corpus shares is ever gathered in one place.
4. A node of full depth with suffixes of two documents or more is a repeat. Its smallest doc_id keeps its words; in the other
   documents every word below it goes. Neighbouring ones join to maximal repeats (``maximal_repeats``).

Defined cases: a null or empty text has no words and keeps nothing (the empty string). A row with a null
doc_id takes no part and keeps all its words. Rows that repeat a doc_id are one document: none of them is removed
on account of the other, and each loses what it repeats itself. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import id_type, small_batches
from zonecast.llm.wordhash import Words, in_chunks, runs
from zonecast.session import Scratch, materialise

WINDOW, PREFIX = 50, 20
# Suffixes that a group may have for its tree to be built in one task: some 400 bytes each.
GROUP = 4096


def _least_of(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive values."""
    n = len(values) - size + 1
    width, out = 1, values
    while 2 * width <= size:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return np.minimum(out[:n], out[size - width : size - width + n])


class _Windows:
    """Of a run of texts: the group prefix and the fingerprint of each window, by text."""

    def __init__(self, texts: list[str]) -> None:
        self.words = Words(texts)
        h = self.words.hashes
        self.windows = runs(h, WINDOW)
        self.prefixes = _least_of(runs(h, PREFIX), WINDOW - PREFIX + 1) if len(self.windows) else self.windows

    def __iter__(self) -> Iterator[tuple[int, int, slice]]:
        """Of each text: first word, last-plus-one word, and its windows."""
        for first, last in self.words:
            yield first, last, slice(first, max(first, last - WINDOW + 1))


def survey(docs: DataFrame) -> DataFrame:
    """Of each row: id, text hash, number of words, a key of the word sequence, and its group prefixes with the windows of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, prefixes, counts = [], [], [], []
            for _, texts in in_chunks(batch.column("text").to_pylist()):
                found = _Windows(texts)
                for first, last, windows in found:
                    sizes.append(last - first)
                    keys.append(hashlib.blake2b(found.words.hashes[first:last].tobytes(), digest_size=16).digest())
                    own, many = np.unique(found.prefixes[windows], return_counts=True)
                    prefixes.append(own.view(np.int64))
                    counts.append(many)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("__text"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                names=["doc_id", "__text", "n_words", "key", "prefixes", "counts"],
            )

    return small_batches(docs.select("doc_id", F.xxhash64("text").alias("__text"), "text")).mapInArrow(
        run, f"doc_id {id_type(docs)}, __text long, n_words long, key binary, prefixes array<long>, counts array<long>"
    )


def _lengthen(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The suffixes of the documents in ``wanted`` (``id``, ``of``, ``narrow``, ``wide``) whose group is in one of the two lists.

    Of a narrow group: a row a stretch of suffixes that follow each other, with its ``words`` (a hash each) from the first suffix's first to the
    last one's fiftieth. Of a wide group: a row for each fingerprint of a suffix's first fifty words (``window``) in a ``part``, that is the texts read at
    once, with all its ``places`` there.
    """
    kind = id_type(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, narrow, wide = batch.column("text").to_pylist(), batch.column("narrow"), batch.column("wide")
            ids, of = batch.column("id"), batch.column("of")
            for at, some in in_chunks(texts):
                found = _Windows(some)
                rows, starts, prefixes, words = [], [], [], []
                places = [np.zeros((0, 4), np.int64)]
                for k, (first, _, windows) in enumerate(found):
                    own = found.prefixes[windows]
                    hit = np.flatnonzero(np.isin(own, np.asarray(narrow[at + k].values).view(np.uint64)))
                    if len(hit):
                        cuts = np.flatnonzero((np.diff(hit) > 1) | (own[hit[1:]] != own[hit[:-1]])) + 1
                        for a, b in zip(hit[np.append(0, cuts)].tolist(), hit[np.append(cuts - 1, len(hit) - 1)].tolist(), strict=True):
                            rows.append(at + k)
                            starts.append(a)
                            prefixes.append(own[a])
                            words.append(found.words.hashes[first + a : first + b + WINDOW].tobytes())
                    hit = np.flatnonzero(np.isin(own, np.asarray(wide[at + k].values).view(np.uint64)))
                    columns = own[hit].view(np.int64), found.windows[windows][hit].view(np.int64), np.full(len(hit), at + k), hit
                    places.append(np.stack(columns, axis=1))
                placed = np.concatenate(places)
                placed = placed[np.lexsort((placed[:, 1], placed[:, 0]))]
                cuts = np.flatnonzero((placed[1:, :2] != placed[:-1, :2]).any(axis=1)) + 1
                firsts = np.append(0, cuts) if len(placed) else cuts
                taken, here = pa.array(rows, pa.int64()), pa.array(placed[:, 2])
                each = pa.StructArray.from_arrays([ids.take(here), of.take(here), pa.array(placed[:, 3].astype(np.int32))], ["id", "of", "start"])
                trees, deep = len(rows), len(firsts)
                lists = pa.ListArray.from_arrays(pa.array(np.append(firsts, len(placed)).astype(np.int32)), each)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([ids.take(taken), pa.nulls(deep, ids.type)]),
                        pa.concat_arrays([of.take(taken), pa.nulls(deep, of.type)]),
                        pa.concat_arrays([pa.array(starts, pa.int32()), pa.nulls(deep, pa.int32())]),
                        pa.array(np.append(np.array(prefixes, np.uint64).view(np.int64), placed[firsts, 0])),
                        pa.concat_arrays([pa.array(words, pa.binary()), pa.nulls(deep, pa.binary())]),
                        pa.array(np.full(trees + deep, part)),
                        pa.concat_arrays([pa.nulls(trees, pa.int64()), pa.array(placed[firsts, 1])]),
                        pa.concat_arrays([pa.nulls(trees, lists.type), lists]),
                    ],
                    names=["doc_id", "__text", "start", "prefix", "words", "part", "window", "places"],
                )
                part += 1

    rows = docs.select("doc_id", F.xxhash64("text").alias("__hash"), "text")
    rows = rows.join(wanted, (F.col("doc_id") == F.col("id")) & (F.col("__hash") == F.col("of")))
    return small_batches(rows.select("id", "of", "text", "narrow", "wide")).mapInArrow(
        run,
        f"doc_id {kind}, __text long, start int, prefix long, words binary, part long, window long, "
        f"places array<struct<id: {kind}, of: long, start: int>>",
    )


def _groups(batches: Iterator[pa.RecordBatch], by: str = "prefix") -> Iterator[pa.RecordBatch]:
    """The rows of one group after the other, of batches sorted by its key."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not len(batch):
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        starts = [0, *(np.flatnonzero(np.diff(batch.column(by).to_numpy())) + 1).tolist()]
        for a, b in zip(starts, starts[1:], strict=False):
            yield batch.slice(a, b - a)
        held = batch.slice(starts[-1])
    if held is not None:
        yield held


class Subtree:
    """The suffix tree of one group, cut at ``WINDOW`` words: its suffixes in order, and how many words each shares with the one before.

    Suffixes below an internal node are a run of the order; a node is as deep as the least that is shared inside its run.
    """

    def __init__(self, stretches: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in stretches])
        ends = np.cumsum(sizes)
        many = sizes - WINDOW + 1
        self.stretch = np.repeat(np.arange(len(sizes)), many)
        self.offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        every = np.lib.stride_tricks.sliding_window_view(np.concatenate(stretches), WINDOW)
        suffixes = np.ascontiguousarray(every[np.repeat(ends - sizes, many) + self.offset])
        self.order = np.argsort(suffixes.view(f"V{8 * WINDOW}").ravel(), kind="stable")
        placed = suffixes[self.order]
        differs = placed[1:] != placed[:-1]
        self.shared = np.where(differs.any(axis=1), differs.argmax(axis=1), WINDOW)

    def repeated(self, owner: np.ndarray) -> np.ndarray:
        """Whether each suffix is below a node of full depth that a stretch of a smaller ``owner`` is below too."""
        starts = np.append(0, np.flatnonzero(self.shared < WINDOW) + 1)
        of = owner[self.stretch[self.order]]
        least = np.repeat(np.minimum.reduceat(of, starts), np.diff(np.append(starts, len(of))))
        out = np.empty(len(of), bool)
        out[self.order] = of > least
        return out


def _spans_of_trees(narrow: DataFrame) -> DataFrame:
    """(``doc_id``, ``__text``, ``start``, ``length``) of the runs of words that each group's tree finds repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            _, owner = np.unique(group.column("doc_id").to_numpy(zero_copy_only=False), return_inverse=True)
            if owner.max() == 0:
                continue
            tree = Subtree([np.frombuffer(w.as_buffer(), np.uint64) for w in group.column("words")])
            hit = np.flatnonzero(tree.repeated(owner))
            if not len(hit):
                continue
            cuts = np.flatnonzero((np.diff(hit) > 1) | (tree.stretch[hit[1:]] != tree.stretch[hit[:-1]])) + 1
            firsts, lasts = hit[np.append(0, cuts)], hit[np.append(cuts - 1, len(hit) - 1)]
            taken = tree.stretch[firsts]
            found = pa.RecordBatch.from_arrays(
                [
                    group.column("doc_id").take(pa.array(taken)),
                    group.column("__text").take(pa.array(taken)),
                    pa.array((group.column("start").to_numpy()[taken] + tree.offset[firsts]).astype(np.int32)),
                    pa.array((lasts - firsts + WINDOW).astype(np.int32)),
                ],
                names=["doc_id", "__text", "start", "length"],
            )
            yield found

    kind = id_type(narrow)
    dealt = narrow.select("doc_id", "__text", "start", "prefix", "words").repartition("prefix").sortWithinPartitions("prefix")
    return small_batches(dealt).mapInArrow(run, f"doc_id {kind}, __text long, start int, length int")


def _spans_of_parts(places: DataFrame) -> DataFrame:
    """(``doc_id``, ``__text``, ``start``, ``length``) of the runs of words that the repeated ``places`` of each ``part`` make."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "part"):
            ids, of, start = group.column("places").flatten().flatten()
            _, owner = np.unique(ids.to_numpy(zero_copy_only=False), return_inverse=True)
            of_, begun = of.to_numpy(), start.to_numpy()
            order = np.lexsort((begun, of_, owner))
            new = (np.diff(owner[order]) != 0) | (of_[order][1:] != of_[order][:-1]) | (np.diff(begun[order]) > 1)
            firsts = order[np.append(True, new)]
            lasts = order[np.append(new, True)]
            taken = pa.array(firsts)
            yield pa.RecordBatch.from_arrays(
                [ids.take(taken), of.take(taken), start.take(taken), pa.array((begun[lasts] - begun[firsts] + WINDOW).astype(np.int32))],
                names=["doc_id", "__text", "start", "length"],
            )

    kind = places.schema["places"].dataType.elementType["id"].dataType.simpleString()
    dealt = places.repartition("part").sortWithinPartitions("part")
    return small_batches(dealt).mapInArrow(run, f"doc_id {kind}, __text long, start int, length int")


def repeats(docs: DataFrame, work: Scratch, group: int = GROUP) -> DataFrame:
    """(``id``, ``of``, ``spans``) of each document with repeats: ids, text hashes and the sorted (start, length) of what is repeated.

    Spans of neighbouring groups may overlap; together they are the document's maximal repeats. They are a part of the document and so no larger than it.
    """
    own = work.store(survey(docs), "survey").where("doc_id is not null")
    long = own.where(F.col("n_words") >= WINDOW)
    heads = work.store(long.groupBy(F.col("key").alias("__key")).agg(F.min("doc_id").alias("head")), "word-classes")
    placed = long.join(heads, F.col("key") == F.col("__key"))
    groups = placed.where("doc_id = head").select(
        "doc_id", "__text", F.explode(F.arrays_zip("prefixes", "counts")).alias("g")
    ).select("doc_id", "__text", F.col("g.prefixes").alias("prefix"), F.col("g.counts").alias("n"))
    # A prefix of one document's windows has nothing below it that could repeat another.
    sizes = groups.groupBy("prefix").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.sum("n").alias("suffixes")).where("a < b")
    shared = work.store(sizes.select(F.col("prefix").alias("__prefix"), (F.col("suffixes") > group).alias("is_wide")), "prefixes")
    wanted = groups.join(shared, F.col("prefix") == F.col("__prefix")).groupBy(F.col("doc_id").alias("id"), F.col("__text").alias("of")).agg(
        F.collect_set(F.when(~F.col("is_wide"), F.col("prefix"))).alias("narrow"),
        F.collect_set(F.when(F.col("is_wide"), F.col("prefix"))).alias("wide"),
    )
    suffixes = work.store(_lengthen(docs, wanted), "suffixes")
    windows = suffixes.where("window is not null").select("part", "prefix", "window", "places")
    nodes = windows.groupBy("prefix", "window").agg(
        F.min(F.array_min("places.id")).alias("least"), F.max(F.array_max("places.id")).alias("most")
    )
    nodes = work.store(nodes.where("least < most").select("prefix", "window", "least"), "deep-nodes")
    below = windows.join(nodes, ["prefix", "window"]).where(F.array_max("places.id") > F.col("least"))
    below = below.select("part", F.filter("places", lambda p: p["id"] > F.col("least")).alias("places"))
    spans = _spans_of_trees(suffixes.where("words is not null")).unionByName(_spans_of_parts(below))
    whole = placed.where("doc_id > head").select("doc_id", "__text", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("length"))
    return spans.unionByName(whole).groupBy(F.col("doc_id").alias("id"), F.col("__text").alias("of")).agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans")
    )


def maximal_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(``doc_id``, ``__text``, ``start``, ``length``): the stretches of words whose every window of 50 starts in a smaller document too, as long as they get."""
    with Scratch(docs.sparkSession, "repeats") as work:
        each = repeats(docs, work, group).select(F.col("id").alias("doc_id"), F.col("of").alias("__text"), F.explode("spans").alias("s"))
        here = Window.partitionBy("doc_id", "__text").orderBy("s")
        # Windows that start within 50 words of each other but not one after the other are stretches of their own.
        reach = F.max(F.col("s.start") + F.col("s.length") - WINDOW).over(here.rowsBetween(Window.unboundedPreceding, -1))
        first = F.when(F.col("s.start") <= reach + 1, 0).otherwise(1)
        numbered = each.withColumn("first", first).withColumn("run", F.sum("first").over(here.rowsBetween(Window.unboundedPreceding, 0)))
        joined = numbered.groupBy("doc_id", "__text", "run").agg(
            F.min("s.start").alias("start"), (F.max(F.col("s.start") + F.col("s.length")) - F.min("s.start")).alias("length")
        )
        return materialise(joined.drop("run"), "maximal-repeats")


def remove_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``doc_id``, a hash of the row's text, ``n_words``, ``n_removed``, and ``kept``: the words left, joined by one space."""
    with Scratch(docs.sparkSession, "substring-dedup") as work:
        found = materialise(repeats(docs, work, group), "repeats")
    rows = docs.select("doc_id", F.xxhash64("text").alias("__text"), "text")
    rows = rows.join(found, (rows["doc_id"] == found["id"]) & (F.col("__text") == found["of"]), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            starts, lengths = batch.column("starts"), batch.column("lengths")
            for at, texts in in_chunks(batch.column("text").to_pylist()):
                words = Words(texts)
                for k, (first, last) in enumerate(words):
                    n = last - first
                    keep = np.ones(n, bool)
                    if starts[at + k].is_valid:
                        begun = np.asarray(starts[at + k].values)
                        steps = np.zeros(n + 1, np.int64)
                        np.add.at(steps, begun, 1)
                        np.add.at(steps, begun + np.asarray(lengths[at + k].values), -1)
                        keep = np.cumsum(steps[:n]) == 0
                    stay = np.flatnonzero(keep) + first
                    spans = zip(words.starts[stay].tolist(), words.ends[stay].tolist(), strict=True)
                    sizes.append(n)
                    removed.append(n - len(stay))
                    kept.append(b" ".join([words.data[a:b] for a, b in spans]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("__text"),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "__text", "n_words", "n_removed", "kept"],
            )

    spans = [F.col("spans.start").alias("starts"), F.col("spans.length").alias("lengths")]
    return small_batches(rows.select("doc_id", "__text", "text", *spans)).mapInArrow(
        run, f"doc_id {id_type(docs)}, __text long, n_words long, n_removed long, kept string"
    )


def digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def rewrite(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats cut from ``text`` (and ``n_chars``, if there, brought up to date).

    Rows without a repeat keep their text as it is, white space included; null texts stay null. All other columns stay.
    """
    cut = remove_repeats(docs).where("n_removed > 0").select(
        F.col("doc_id").alias("__id"), F.col("__text").alias("__hash"), F.col("kept").alias("__kept")
    )
    joined = docs.join(
        cut.dropDuplicates(["__id", "__hash"]),
        docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__hash")),
        "left",
    )
    text = F.coalesce("__kept", docs["text"])
    new = {"text": text, "n_chars": F.when(F.col("__kept").isNull(), docs["n_chars"]).otherwise(F.length(text).cast("long")) if "n_chars" in docs.columns else None}
    return joined.select(*((new[c].alias(c) if new.get(c) is not None else docs[c]) for c in docs.columns))
