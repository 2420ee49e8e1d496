"""Near-duplicates by the chosen-path method: a set similarity join by random recursive branching.

A document's set holds its distinct shingles of five words (ASCII letters in lower case); with fewer words
the whole sequence is its one shingle; without words it is empty. Two documents are linked when their
sets' Jaccard similarity is at least 0.75, and a component is what links connect.

1. Equal sets form a class, of which the smallest doc_id goes on.
2. In each of many independent trees a node chooses one or two minwise hashes (4/3 on average, that is 1 / 0.75, as the
   method asks), and a document goes to the child named by its token there. Similar documents follow the same path with
   high probability. A tree has minwise hashes of its own, ``SLOTS`` at each depth.
3. A node is small while fewer than ``SMALL`` of its documents are outside its largest connected part (at first each
   document is a part of its own). What is outside is compared with the whole node exhaustively. In a larger node each document is compared
   with the smallest id that it meets, and then the node branches once. Nodes are counted at every depth.
4. Candidates whose tokens at ``POSITIONS`` further hashes agree as rarely as a similarity of 0.75 all but never would (below
   ``AGREE`` of 64; it happens to one such pair in 10^8) are dropped; all others are confirmed on their full sets.
5. Links are joined to components. A node whose documents are all connected by then holds nothing more to
   find, so groups of copies of any size end there. The others branch until nothing is left.
6. Where documents are left in large nodes they enter more trees, which start at the depth reached: ``TREES`` of them in all.

Two documents with a similarity of 0.75 share a node in one tree with probability 0.81 at depth 1, 0.53 at 4, 0.33 at 10 and 0.13
at 34 (``_share``). They are missed if at some depth none of the trees holds both; the number of trees at each depth keeps
the sum over all depths below ``MISSED``, at any size of the group. Higher similarities are missed less.

Defined cases: a null or empty text has an empty set, is linked with nothing and is kept. A row with a null
doc_id takes no part: its component is null and it is kept. Rows that repeat a doc_id are one document
if their texts are equal, else texts of their own that share the id. An empty table gives an empty result.
Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import id_type, keep_rows, small_batches
from zonecast.llm.components import components
from zonecast.llm.wordhash import U, Words, in_chunks, mix, runs
from zonecast.session import Scratch, materialise

SHINGLE = 5
POSITIONS, AGREE = 64, 28
# A node is small while fewer documents than this, with fewer shingles in all, are outside its largest component.
SMALL, VOLUME = 1024, 1 << 20
# Token bytes that are compared at once.
COMPARED = 1 << 23
# Nodes that are still large at this depth are compared exhaustively.
ROUNDS = 34
# A pair of similarity 0.75 may be missed with this probability.
MISSED = 1e-6
# Minwise hashes of a tree at each depth, from which its nodes there choose.
SLOTS = 16
# Documents whose rows are worth a task of their own. Fewer tasks than two a core are never asked for.
A_TASK = 4096
# The low bits of a node name its tree.
TREE_BITS = U(0xFF)


def _share(depth: int) -> float:
    """The probability that a tree holds two documents of similarity 0.75 in one node at a depth."""
    share = 1.0
    for _ in range(depth):
        share = (2 * (0.75 * share) + 1 - (1 - 0.75 * share) ** 2) / 3
    return share


# How many trees there are at each depth (none at depth 0).
TREES = [0, *(math.ceil(math.log(MISSED / ROUNDS) / math.log(1 - _share(d))) for d in range(1, ROUNDS + 1))]
ROOTS = (mix(np.arange(1, TREES[-1] + 1, dtype=np.uint64) * U(0xE7037ED1A0B428DB)) & ~TREE_BITS) | np.arange(TREES[-1], dtype=np.uint64)

_RANDOM = mix(np.arange(1, 4 * POSITIONS + 1, dtype=np.uint64) * U(0xA0761D6478BD642F))
_MULTIPLY, _ADD = _RANDOM[:POSITIONS] | U(1), _RANDOM[POSITIONS : 2 * POSITIONS]


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, run in in_chunks(texts):
        words = Words(run, lower=True)
        shingles = runs(words.hashes, SHINGLE)
        for first, last in words:
            if last - first >= SHINGLE:
                yield np.unique(shingles[first : last - SHINGLE + 1])
            elif last > first:
                yield runs(words.hashes[first:last], last - first)
            else:
                yield np.zeros(0, np.uint64)


def minwise(shingles: np.ndarray, multiply: np.ndarray = _MULTIPLY, add: np.ndarray = _ADD) -> np.ndarray:
    """The least of each 32-bit hash over the set; a hash is named by its factor and its summand."""
    out = np.full(len(multiply), 0xFFFFFFFF, np.uint64)
    for of in range(0, len(multiply), POSITIONS):
        some = slice(of, of + POSITIONS)
        for at in range(0, len(shingles), 4096):
            hashed = (shingles[None, at : at + 4096] * multiply[some, None] + add[some, None]) >> U(32)
            np.minimum(out[some], hashed.min(axis=1), out=out[some])
    return out


def children(nodes: np.ndarray, depth: int, shingles: np.ndarray) -> np.ndarray:
    """The children at ``depth`` of nodes a depth above, for the document with these shingles (one or two of each node)."""
    drawn, slots = mix(nodes ^ U(0x5851F42D4C957F2D)), U(SLOTS)
    first, both = drawn % slots, (drawn >> U(40)) % U(3) == U(0)
    second = (first + U(1) + (drawn >> U(20)) % (slots - U(1))) % slots
    above, slot = np.concatenate([nodes, nodes[both]]), np.concatenate([first, second[both]])
    tree = above & TREE_BITS
    used, at = np.unique((tree * U(ROUNDS + 1) + U(depth)) * slots + slot, return_inverse=True)
    seeds = mix((used + U(1)) * U(0x9FB21C651E98DF25))
    tokens = minwise(shingles, mix(seeds ^ U(0xD6E8FEB86659FD93)) | U(1), mix(seeds + U(1)))
    return (mix(mix(above + slot + U(1)) ^ tokens[at]) & ~TREE_BITS) | tree


def entered(depth: int, shingles: np.ndarray) -> np.ndarray:
    """The nodes at ``depth`` of the trees that start there."""
    nodes = ROOTS[TREES[depth - 1] : TREES[depth]]
    for d in range(1, depth + 1):
        nodes = children(nodes, d, shingles)
    return nodes


def sketches(docs: DataFrame) -> DataFrame:
    """Of each row: id, text hash, set size, a key of the set, the tokens, and its nodes below the roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, tokens, nodes = [], [], [], []
            for shingles in shingle_sets(batch.column("text").to_pylist()):
                sizes.append(len(shingles))
                keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                tokens.append(minwise(shingles).astype("<u4").tobytes())
                nodes.append(entered(1, shingles).view(np.int64) if len(shingles) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("__text"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(tokens, pa.binary()),
                    pa.array(nodes, pa.list_(pa.int64())),
                ],
                names=["doc_id", "__text", "n", "key", "tokens", "nodes"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("__text"), "text")
    return small_batches(rows).mapInArrow(
        run, f"doc_id {id_type(docs)}, __text long, n long, key binary, tokens binary, nodes array<long>"
    )


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(``id``, ``n``, ``shingles`` binary) of the documents in ``wanted`` (``id``), from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s.tobytes() for s in shingle_sets(batch.column("text").to_pylist())]
            n = pa.array([len(s) // 8 for s in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), n, pa.array(found, pa.binary())], names=["id", "n", "shingles"])

    rows = docs.select(F.col("doc_id").alias("id"), "text").join(wanted, "id", "left_semi")
    return small_batches(rows).mapInArrow(run, f"id {id_type(docs)}, n long, shingles binary")


def _agree(pairs: DataFrame, tokens: DataFrame, work: Scratch) -> DataFrame:
    """The pairs (``a``, ``b``) whose tokens agree at ``AGREE`` positions or more and whose sizes allow 0.75."""
    kind = id_type(pairs, "a")
    side = lambda x: tokens.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("low").alias(f"low_{x}"))
    both = work.narrow(work.narrow(pairs).join(side("a"), "a")).join(side("b"), "b").where("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, POSITIONS) for c in ("low_a", "low_b"))
            equal = (a == b).sum(axis=1)
            out = pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(equal.astype(np.int32))], names=["a", "b", "agree"]
            )
            yield out.filter(pa.array(equal >= AGREE))

    return work.narrow(both.select("a", "b", "low_a", "low_b")).mapInArrow(run, f"a {kind}, b {kind}, agree int")


def _confirm(pairs: DataFrame, sets: DataFrame, work: Scratch) -> DataFrame:
    """The pairs whose full sets have a Jaccard similarity of at least 0.75."""
    kind = id_type(pairs, "a")
    side = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"set_{x}"))
    both = work.narrow(pairs.select("a", "b").join(side("a"), "a")).join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= 75 * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return small_batches(work.narrow(both.select("a", "b", "set_a", "set_b"))).mapInArrow(run, f"a {kind}, b {kind}")


def _branch(rows: DataFrame, sets: DataFrame, depth: int, work: Scratch) -> DataFrame:
    """The children (``node``, ``id``, ``n``) at ``depth`` of rows (``node``, ``id``, ``n``), and their nodes of the trees that start there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            below = []
            for nodes, shingles in zip(batch.column("nodes"), batch.column("shingles"), strict=True):
                nodes = nodes.values.to_numpy(zero_copy_only=False).view(np.uint64)
                shingles = np.frombuffer(shingles.as_buffer(), np.uint64)
                below.append(np.concatenate([children(nodes, depth, shingles), entered(depth, shingles)]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n"), pa.array(below, pa.list_(pa.int64()))], names=["id", "n", "below"]
            )

    of_document = rows.groupBy("id", "n").agg(F.collect_set("node").alias("nodes"))
    with_sets = of_document.join(sets, ["id", "n"]).select("id", "n", "nodes", "shingles")
    below = small_batches(work.narrow(with_sets)).mapInArrow(
        run, f"id {id_type(rows, 'id')}, n long, below array<long>"
    )
    return below.select(F.explode("below").alias("node"), "id", "n")


def _divided(rows: DataFrame) -> DataFrame:
    """The rows (``node``, ``id``, ``n``, ``component``) of nodes that hold more than one component."""
    nodes = rows.groupBy("node").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return rows.join(nodes.where("low <> high").select("node"), "node", "left_semi")


def _counted(rows: DataFrame, work: Scratch) -> DataFrame:
    """Rows (``node``, ``id``, ``n``, ``component``) of nodes that hold two components or more, with what the node holds, stored.

    ``least`` is its smallest id with the component of that, ``main`` its largest component; ``size`` and ``volume`` count its documents and their
    shingles, ``others`` and ``other_volume`` those outside ``main``.
    """
    inside = rows.groupBy("node", "component").agg(
        F.count("*").alias("here"), F.sum("n").alias("shingles"), F.min("id").alias("least")
    )
    counted = work.narrow(inside).groupBy("node").agg(
        F.count("*").alias("parts"),
        F.min(F.struct("least", "component")).alias("first"),
        F.max(F.struct("here", "component", "shingles")).alias("top"),
        F.sum("here").alias("size"),
        F.sum("shingles").alias("volume"),
    )
    shared = counted.where("parts > 1").select(
        "node",
        F.col("first.least").alias("least"),
        F.col("first.component").alias("least_component"),
        F.col("top.component").alias("main"),
        "size",
        "volume",
        (F.col("size") - F.col("top.here")).alias("others"),
        (F.col("volume") - F.col("top.shingles")).alias("other_volume"),
    )
    shared = work.store(shared, "nodes")
    held = work.store(rows.join(shared, "node"), "node-rows")
    work.drop(shared)
    return held


def _is_small() -> Column:
    return (F.col("others") < SMALL) & (F.col("other_volume") < VOLUME)


def _cells(rows: DataFrame) -> DataFrame:
    """Rows of nodes dealt into cells (``node``, ``cell``) of bounded size, so that each outsider meets each document of its node in one of them.

    Documents are dealt into as many parts as their number or volume asks for, outsiders once more into parts of their own: one, in a small
    node. A cell has one part of the outsiders and one of all documents (``member``).
    """
    parts = lambda many, shingles: F.greatest(F.lit(1), F.ceil(many / SMALL), F.ceil(shingles / VOLUME)).cast("int")
    all_parts, out_parts = parts(F.col("size"), F.col("volume")), parts(F.col("others"), F.col("other_volume"))
    own, own_out = F.pmod(F.xxhash64("id"), F.col("parts")), F.pmod(F.xxhash64("id", F.lit(1)), F.col("out_parts"))
    placed = rows.withColumns({"parts": all_parts, "out_parts": out_parts, "apart": F.col("component") != F.col("main")})
    is_out = lambda cell: F.col("apart") & (F.floor(cell / F.col("parts")) == own_out)
    is_member = lambda cell: cell % F.col("parts") == own
    cells = F.filter(F.sequence(F.lit(0), F.col("parts") * F.col("out_parts") - 1), lambda c: is_out(c) | is_member(c))
    dealt = placed.withColumn("cell", F.explode(cells))
    cell = F.col("cell")
    return dealt.select("node", "cell", "id", "n", "component", is_out(cell).alias("outside"), is_member(cell).alias("member"))


def _by_cell(rows: DataFrame, work: Scratch) -> DataFrame:
    return small_batches(work.narrow(rows.repartition("node", "cell")).sortWithinPartitions("node", "cell"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one cell after the other, of batches sorted by cell."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not len(batch):
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        node, cell = (batch.column(c).to_numpy() for c in ("node", "cell"))
        cuts = np.flatnonzero((np.diff(node) != 0) | (np.diff(cell) != 0)) + 1
        starts = [0, *cuts.tolist()]
        for a, b in zip(starts, starts[1:], strict=False):
            yield batch.slice(a, b - a)
        held = batch.slice(starts[-1])
    if held is not None:
        yield held


def _flags(cell: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of a cell's outsiders and members, and the components as numbers."""
    outside, member = (cell.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("outside", "member"))
    _, component = np.unique(cell.column("component").to_numpy(zero_copy_only=False), return_inverse=True)
    return np.flatnonzero(outside), np.flatnonzero(member), component


def _alike(cells: DataFrame, tokens: DataFrame, work: Scratch) -> DataFrame:
    """The rows of the cells that may link: with another component's document in the cell, tokens agree and sizes allow 0.75.

    All outsiders of a cell are compared with all its members; what leaves is documents, never pairs.
    """
    rows = work.narrow(cells.join(tokens.select("id", "low"), "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _groups(batches):
            outs, members, component = _flags(cell)
            low = np.frombuffer(b"".join(cell.column("low").to_pylist()), np.uint8).reshape(-1, POSITIONS)
            n = cell.column("n").to_numpy()
            found = np.zeros(len(cell), bool)
            step = max(1, COMPARED // (max(1, len(members)) * POSITIONS))
            for at in range(0, len(outs), step):
                some = outs[at : at + step]
                near = (low[some][:, None, :] == low[members][None]).sum(axis=2, dtype=np.uint8) >= AGREE
                near &= component[some][:, None] != component[members][None]
                x, y = n[some][:, None], n[members][None]
                near &= 4 * np.minimum(x, y) >= 3 * np.maximum(x, y)
                found[some] |= near.any(axis=1)
                found[members] |= near.any(axis=0)
            if found.any():
                yield cell.filter(pa.array(found)).drop_columns(["low"])

    kind = id_type(cells, "id")
    columns = ["node", "cell", "id", "n", "component", "outside", "member"]
    return _by_cell(rows.select(*columns, "low"), work).mapInArrow(
        run, f"node long, cell int, id {kind}, n long, component {kind}, outside boolean, member boolean"
    )


def _compared(alike: DataFrame, sets: DataFrame, work: Scratch) -> DataFrame:
    """The links (``a``, ``b``) between components that the full sets of a cell's documents confirm, as many as join what belongs together."""
    rows = work.narrow(alike.join(sets.select("id", "shingles"), "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _groups(batches):
            outs, members, component = _flags(cell)
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in cell.column("shingles")]
            n = np.array([len(x) for x in sets])
            codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
            starts = np.cumsum(n) - n
            inside = np.concatenate([codes[starts[m] : starts[m] + n[m]] for m in members])
            firsts = np.cumsum(n[members]) - n[members]
            held = np.zeros(codes.max() + 1, np.int32)
            a, b = [], []
            for o in outs.tolist():
                own = codes[starts[o] : starts[o] + n[o]]
                held[own] = 1
                shared = np.add.reduceat(held[inside], firsts)
                held[own] = 0
                linked = members[100 * shared >= 75 * (n[o] + n[members] - shared)]
                joined, at = np.unique(component[linked], return_index=True)
                for part, m in zip(joined.tolist(), linked[at].tolist(), strict=True):
                    if part != component[o]:
                        a.append(o)
                        b.append(m)
                        component[component == part] = component[o]
            if a:
                ids = cell.column("id")
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], names=["a", "b"])

    kind = id_type(alike, "id")
    columns = ["node", "cell", "id", "component", "outside", "member", "shingles"]
    return _by_cell(rows.select(*columns), work).mapInArrow(run, f"a {kind}, b {kind}")


class _Links:
    """The links confirmed so far and the components they make, with the full sets read for them.

    ``paths``, when set, holds the full sets of every document that is still compared; none is read from its text again then.
    """

    def __init__(self, docs: DataFrame, work: Scratch) -> None:
        self.docs, self.work = docs, work
        self.found = self.sets = self.paths = None

    def with_sets(self, ids: DataFrame) -> DataFrame:
        """The sets of these ids (``id``) and of others."""
        if self.paths is not None:
            return self.paths
        ids = ids.distinct() if self.sets is None else ids.distinct().join(self.sets.select("id"), "id", "left_anti")
        ids = self.work.store(ids, "ends")
        new = self.work.store(_sets(self.docs, ids), "sets")
        self.work.drop(ids)
        self.sets = new if self.sets is None else self.sets.unionByName(new)
        return self.sets

    def add(self, confirmed: DataFrame) -> bool:
        """Join the components that these links connect; whether there are any."""
        confirmed = self.work.store(confirmed, "confirmed")
        if confirmed.isEmpty():
            return False
        # What is joined already is told by one link an id; the new links go on top.
        known = None if self.found is None else self.found.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
        links = confirmed if known is None else confirmed.unionByName(known)
        before, self.found = self.found, components(links, store=self.work.store)
        self.work.drop(before, confirmed)
        return True

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows (``node``, ``id``, ``n``) with the component of each id so far."""
        rows = rows.select("node", "id", "n")
        return rows.withColumn("component", F.col("id")) if self.found is None else _placed(rows, self.found)


def link_classes(docs: DataFrame, classes: DataFrame, work: Scratch) -> DataFrame | None:
    """(``id``, ``component``) of all ids that have a link, stored in ``work``, or None; classes have ``id``, ``n``, ``low``, ``nodes``.

    A turn's tables are deleted when the next turn's are stored; what lasts is the components and the sets read. Nodes are placed and counted
    again only where new links were found.
    """
    tokens = classes.select("id", "n", "low")
    links = _Links(docs, work)
    rows = classes.select(F.explode(F.array_distinct("nodes")).alias("node"), "id", "n")
    for depth in range(1, ROUNDS + 1):
        before, rows = rows, _counted(links.placed(rows), work)
        work.drop(before)
        if rows.isEmpty():
            break
        # Each document with the least id that it meets, at one node and at another: what joins groups of copies of any size.
        # Below the first depth that is for large nodes; the documents of small ones are all compared in this turn.
        met = rows.where("component <> least_component")
        ends = (met if depth == 1 else met.where(~_is_small())).groupBy(F.col("id").alias("b")).agg(
            F.min("least").alias("x"), F.max("least").alias("y")
        )
        stars = ends.select(F.explode(F.array_distinct(F.array("x", "y"))).alias("a"), "b")
        stars = work.store(_agree(stars, tokens, work), "stars")
        if not stars.isEmpty():
            sets = links.with_sets(stars.select(F.col("a").alias("id")).unionByName(stars.select(F.col("b").alias("id"))))
            if links.add(_confirm(stars, sets, work)):
                before, rows = rows, _counted(links.placed(rows), work)
                work.drop(before)
        work.drop(stars)
        small = _is_small() if depth < ROUNDS else F.lit(True)
        alike = work.store(_alike(_cells(rows.where(small)), tokens, work), "alike")
        joined = not alike.isEmpty() and links.add(_compared(alike, links.with_sets(alike.select("id")), work))
        work.drop(alike)
        held, rows = rows, rows.where(~small)
        if joined:
            before, rows = held, work.store(_divided(links.placed(rows)), "divided")
            work.drop(before)
            held = rows
        if rows.isEmpty():
            break
        if links.paths is None:  # what is in large nodes later is in large nodes now
            links.paths = work.store(_sets(docs, rows.select("id").distinct()).dropDuplicates(["id", "n", "shingles"]), "path-sets")
        rows = work.store(_branch(rows, links.paths, depth + 1, work), "branches")
        work.drop(held)
    return links.found


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (``node``, ``id``, ``n``) with the component of each id so far."""
    placed = found.withColumnRenamed("id", "__of")
    return rows.join(placed, F.col("id") == F.col("__of"), "left").select(
        "node", "id", "n", F.coalesce("component", "id").alias("component")
    )


def _low_bytes(tokens: object) -> object:
    """The lowest byte of each 32-bit token, as one binary."""
    return F.unhex(F.regexp_replace(F.hex(tokens), "(..)......", "$1"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Of each row: ``doc_id``, the hash of its text, ``n_shingles``, ``component_id``, ``kept``."""
    with Scratch(docs.sparkSession, "near-dedup") as work:
        return materialise(work.narrow(_judged(docs, work)), "near-duplicates")


def _judged(docs: DataFrame, work: Scratch) -> DataFrame:
    own = work.store(sketches(docs), "sketches")
    # Most steps hold few rows a document: with fewer documents than fill the session's partitions, tasks and files would be next to empty.
    work.tasks = max(2 * docs.sparkSession.sparkContext.defaultParallelism, math.ceil(own.count() / A_TASK))
    real = own.where("n > 0 and doc_id is not null")
    # The class's smallest doc_id stands for it.
    heads = work.store(real.groupBy("key").agg(F.min("doc_id").alias("id")), "classes")
    several = heads.withColumnRenamed("key", "__key")
    classes = (
        work.narrow(real.join(several, (F.col("doc_id") == F.col("id")) & (F.col("key") == F.col("__key"))))
        .select("id", "n", "tokens", "nodes")
        .dropDuplicates(["id", "n", "tokens"])
        .select("id", "n", _low_bytes(F.col("tokens")).alias("low"), "nodes")
    )
    found = link_classes(docs, work.store(classes, "class-rows"), work)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"id {id_type(docs)}, component {id_type(docs)}")
    placed = heads.join(found, "id", "left").select(
        F.col("key").alias("__key"), F.coalesce("component", "id").alias("component")
    )
    rows = own.select("doc_id", "__text", "n", "key").join(placed, F.col("key") == F.col("__key"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component")), "doc_id"))
    return rows.select(
        "doc_id",
        "__text",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept: one document of each component; all columns stay."""
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__id"), "__text").distinct()
    return keep_rows(docs, kept)
