"""Quality classifier: ridge regression on random Fourier features of document statistics, then isotonic calibration.

1. Each document has a short vector of statistics of its text (``NAMES``). Labels, language, source and id are no inputs.
2. The statistics are standardised and mapped to ``FEATURES`` random cosines, which approximate a Gaussian kernel.
3. The normal equations are summed by partition, then by blocks of rows over groups of partitions, then over the groups; the driver gets
   one matrix of (FEATURES + 1) squared numbers whatever the input, and solves the ridge system.
4. A fifth of the learning rows is kept from the ridge fit. Their scores, counted in ``BINS`` bins, are made monotone by pooling
   adjacent violators, which gives the probability of label 1.

Defined cases: a null or empty text has statistics of zeros and gets a score like any other. A row with a null id is scored but never
learnt from. Rows that repeat an id are scored alike; conflicting labels of an id are averaged. Null labels are ignored.
Without labels every score is 0.5. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import id_type, materialise, small_batches
from zonecast.llm.wordhash import Words, in_chunks, runs

FEATURES, RIDGE, SEED, BLOCKS, BINS = 256, 1.0, 20, 16, 1000
LOW, HIGH = -0.5, 1.5  # the ridge scores that the bins span

NAMES = (
    "log_words",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "exclamations",
    "bars",
    "other_punctuation",
    "beyond_ascii",
    "line_length",
    "repeated_lines",
    "distinct_words",
    "distinct_trigrams",
    "commonest_word",
    "long_runs",
    "entropy",
)


def _count(shares: np.ndarray, characters: str) -> float:
    return float(shares[[ord(c) for c in characters]].sum())


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of statistics for each text."""
    out = []
    for _, part in in_chunks(texts):
        words = Words(part)
        trigrams = runs(words.hashes, 3)
        for text, (first, last) in zip(part, words, strict=True):
            n = last - first
            if not n:
                out.append([0.0] * len(NAMES))
                continue
            raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            counts = np.bincount(raw, minlength=256)
            shares = counts / len(raw)
            present = shares[shares > 0]
            own, three = words.hashes[first:last], trigrams[first : max(first, last - 2)]
            ids, often = np.unique(own, return_counts=True)
            lines = [x for x in text.split("\n") if x.strip()]
            out.append(
                [
                    math.log1p(n),
                    min(40.0, (len(raw) - _count(counts, " \n\t")) / n),
                    _count(shares, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                    _count(shares, "0123456789"),
                    min(1.0, _count(counts, "#*$%&<>") / n),
                    min(1.0, _count(counts, "!?") / n),
                    min(1.0, _count(counts, "|") / n),
                    min(1.0, _count(counts, ".,;:'\"()-_/\\=+@[]{}~^`") / n),
                    float(shares[128:].sum()),
                    math.log1p(n / max(1, len(lines))),
                    1 - len(set(lines)) / max(1, len(lines)),
                    len(ids) / n,
                    len(np.unique(three)) / max(1, len(three)),
                    float(often.max()) / n,
                    float((own[1:] == own[:-1]).sum()) / n,
                    float(-(present * np.log2(present)).sum()),
                ]
            )
    return np.array(out, np.float64).reshape(-1, len(NAMES))


@dataclass(frozen=True)
class Model:
    """Standardisation, random cosines, ridge weights, and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features of standardised statistics, and a constant."""
        rng = np.random.default_rng(SEED)
        directions = rng.normal(size=(len(NAMES), FEATURES)) / math.sqrt(len(NAMES))
        shifts = rng.uniform(0, 2 * math.pi, FEATURES)
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.hstack([math.sqrt(2 / FEATURES) * np.cos(z @ directions + shifts), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.cosines(stats) @ self.weights, LOW, HIGH)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0, 1)


def pool(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The non-decreasing levels nearest to sums / counts: adjacent violators are pooled."""
    blocks: list[list[float]] = []  # sum, count, bins
    for s, c in zip(sums.tolist(), counts.tolist(), strict=True):
        blocks.append([s, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + c2, blocks[-1][2] + n2]
    return np.concatenate([np.full(int(n), s / c) for s, c, n in blocks])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``stats``) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics(batch.column("text").to_pylist())
            flat = pa.array(found.ravel())
            stats = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(NAMES)), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), stats], names=["doc_id", "stats"])

    return small_batches(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {id_type(docs)}, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def _normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """X'X and X'y of rows (``stats``, ``label``)."""
    size = FEATURES + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            x = model.cosines(_matrix(batch.column("stats")))
            y = batch.column("label").to_numpy(zero_copy_only=False)
            total += x.T @ np.hstack([x, y[:, None]])
        parts = np.array_split(total, BLOCKS)
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array(range(BLOCKS), pa.int32()), "part": [p.tobytes() for p in parts]}
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p) for p in frame["part"])
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "part": [total.tobytes()]})

    parts = rows.select("stats", "label").mapInArrow(partial, "block int, part binary")
    # Two levels of sums: no group has more than some square root of the partitions to add.
    parts = parts.withColumn("spread", F.xxhash64("part") % 64).groupBy("block", "spread").applyInPandas(add, "block int, part binary")
    blocks = parts.groupBy("block").applyInPandas(add, "block int, part binary").orderBy("block").collect()
    total = np.concatenate([np.frombuffer(r["part"]) for r in blocks]).reshape(size, size + 1)
    return total[:, :-1], total[:, -1]


def _counts(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sum of labels and number of rows in each score bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(_matrix(batch.column("stats")))
            bins = np.minimum(((raw - LOW) / (HIGH - LOW) * BINS).astype(np.int32), BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label")], names=["bin", "label"])

    binned = rows.select("stats", "label").mapInArrow(run, "bin int, label double")
    sums, counts = np.zeros(BINS), np.zeros(BINS)
    for r in binned.groupBy("bin").agg(F.sum("label").alias("s"), F.count("*").alias("n")).collect():
        sums[r["bin"]], counts[r["bin"]] = r["s"], r["n"]
    return sums, counts


def fit(rows: DataFrame, calibrate: Column) -> Model:
    """A model from rows (``stats``, ``label`` 0..1); those where ``calibrate`` holds only calibrate it."""
    moments = rows.select(F.posexplode("stats").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("d"))
    found = {r["i"]: (r["m"], r["d"]) for r in moments.collect()}
    mean = np.array([found.get(i, (0, 1))[0] for i in range(len(NAMES))])
    scale = np.array([max(found.get(i, (0, 1))[1], 1e-6) for i in range(len(NAMES))])
    flat = (np.array([LOW, HIGH]), np.array([0.5, 0.5]))
    model = Model(mean, scale, np.zeros(FEATURES + 1), *flat)
    if not found:
        return model
    xx, xy = _normal_equations(rows.where(~calibrate), model)
    weights = np.linalg.solve(xx + RIDGE * np.eye(len(xx)), xy)
    model = Model(mean, scale, weights, *flat)
    sums, counts = _counts(rows.where(calibrate), model)
    seen = np.flatnonzero(counts)
    if not len(seen):
        return Model(mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    centres = LOW + (seen + 0.5) * (HIGH - LOW) / BINS
    return Model(mean, scale, weights, centres, pool(sums[seen], counts[seen]))


def remainder(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def score(docs: DataFrame, labels: DataFrame, held_out: Column, calibrate: Column, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``: learnt from labels (``doc_id``, ``label``) of rows not held out."""
    stats = materialise(document_statistics(docs), "statistics")
    known = labels.where("label is not null and doc_id is not null and doc_id = doc_id").groupBy(
        F.col("doc_id").alias("__id")
    ).agg(F.avg("label").alias("label"))
    rows = stats.where(~held_out).join(known, F.col("doc_id") == F.col("__id")).select("doc_id", "stats", "label")
    model = fit(materialise(rows, "learning-rows"), calibrate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(model.score(_matrix(batch.column("stats"))))],
                names=["doc_id", "held_out", "score"],
            )

    scored = stats.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "stats").mapInArrow(
        run, f"doc_id {id_type(docs)}, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
