"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 5, with word ends) and itself, hashed to ``BUCKETS`` embeddings; misspellings share most of
them. A longer word than ``BLOCK`` characters counts as blocks of so many, each of which overlaps the next by ``OVERLAP``, so no n-gram of it is lost.
The embeddings of every two neighbouring words are averaged and go into a softmax over two classes. A document is as toxic as its most
toxic segment: training starts from the mean over segments and moves to the greatest, so a few words in a long text count.

Learnt from at most ``SAMPLE`` labelled documents a class, those with the smallest hash of their id; the share of toxic documents among all labelled
ones sets the offset. The fit runs on the driver, over that bounded sample; all documents are scored where they lie.

Defined cases: a null or empty text is scored by the share of toxic documents alone. A row with a null id is scored but never learnt from. Rows that
repeat an id are scored each by its text, and learnt from as one, by their least text; conflicting labels of an id count as toxic from one half. Null labels are ignored. Without labels of both classes the
score is their share, or 0.5 without any. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import id_type, small_batches

BUCKETS, DIMENSIONS, SEGMENT, SAMPLE, STEPS = 1 << 17, 8, 2, 2500, 120
BLOCK, OVERLAP = 40, 5
RATE, DECAY, SHARP = 0.1, 5e-4, 30
WORDS_CACHED = 300_000
BLOCK_SEGMENTS = 1 << 17
_words = re.compile(r"[^\s.,;:!?\"()]+").findall


def words(text: str | None) -> list[str]:
    """The words of a text in lower case, long ones as overlapping blocks."""
    found = _words((text or "").lower())
    if all(len(w) <= BLOCK for w in found):
        return found
    return [w[i : i + BLOCK] for w in found for i in range(0, max(1, len(w) - OVERLAP), BLOCK - OVERLAP)]


def subwords(word: str) -> list[int]:
    """Buckets of the word and of its character n-grams."""
    whole = f"<{word}>"
    grams = [whole, *(whole[i : i + n] for n in (3, 4, 5) for i in range(len(whole) - n + 1))]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in grams]


@dataclass
class Model:
    """``lean``: what each bucket adds to the toxic side, that is its embedding times the softmax weights."""

    lean: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.cache: dict[str, float] = {}

    def _learn(self, word: str) -> float:
        value = float(self.lean[subwords(word)].mean())
        if len(self.cache) < WORDS_CACHED:
            self.cache[word] = value
        return value

    def score(self, text: str | None) -> float:
        known, learn = self.cache.get, self._learn
        values = [learn(w) if (v := known(w)) is None else v for w in words(text)]
        best = 0.0
        if values:
            best = float(_segment_means(np.array(values)).max())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, best + self.bias))))


def _segment_means(values: np.ndarray) -> np.ndarray:
    """Of every two neighbouring words; a single word is half a segment."""
    return (values[:-1] + values[1:] if len(values) > 1 else values) / SEGMENT


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """Embeddings and softmax weights, jointly by Adam over the whole sample; labels are 0 or 1, both present."""
    index: dict[str, int] = {}
    tokens = [np.array([index.setdefault(w, len(index)) for w in words(t)], np.int32) for t in texts]
    keep = np.array([len(t) > 0 for t in tokens])
    tokens, labels = [t for t in tokens if len(t)], labels[keep].astype(float)
    bags = [np.array(subwords(w), np.int32) for w in index]
    sizes = np.array([len(b) for b in bags])
    flat, bag_starts = np.concatenate(bags), np.cumsum(sizes) - sizes
    # The words of each segment; a document of one word has one segment without a second word.
    many = np.array([max(1, len(t) - 1) for t in tokens])
    left = np.concatenate([t[: max(1, len(t) - 1)] for t in tokens])
    right = np.concatenate([t[1:] if len(t) > 1 else t for t in tokens])
    alone = np.array([len(t) == 1 for t in tokens])
    first = np.cumsum(many) - many
    # Whole documents of some ``BLOCK_SEGMENTS`` segments are worked on at once.
    ends = [*np.flatnonzero(np.diff(first // BLOCK_SEGMENTS)) + 1, len(many)]
    blocks = [(a, b) for a, b in zip([0, *ends], ends, strict=False) if a < b]
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    rng = np.random.default_rng(seed)
    # Softmax weights of the two classes; only their difference acts.
    p = {"e": rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)), "u": rng.normal(0, 1, (DIMENSIONS, 2)), "b": np.zeros(1)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, STEPS + 1):
        u = p["u"][:, 1] - p["u"][:, 0]
        lean = p["e"] @ u
        word_values = np.add.reduceat(lean[flat], bag_starts) / sizes
        # From the mean over segments to the greatest.
        sharp = SHARP * max(0.0, (step - STEPS / 4) / (STEPS * 3 / 4)) ** 2
        per_word, bias_error = np.zeros(len(index)), 0.0
        for a, b in blocks:
            part, begins = slice(first[a], first[b - 1] + many[b - 1]), first[a:b] - first[a]
            paired = np.repeat(~alone[a:b], many[a:b])
            means = (word_values[left[part]] + paired * word_values[right[part]]) / SEGMENT
            attention = np.exp(np.minimum(0, sharp * (means - np.repeat(np.maximum.reduceat(means, begins), many[a:b]))))
            attention /= np.repeat(np.add.reduceat(attention, begins), many[a:b])
            z = np.add.reduceat(attention * means, begins) + p["b"][0]
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[a:b]) * weight[a:b]
            attention *= np.repeat(error, many[a:b]) / SEGMENT
            per_word += np.bincount(left[part], attention, len(index)) + np.bincount(right[part], attention * paired, len(index))
            bias_error += error.sum()
        per_word /= sizes
        per_bucket = np.bincount(flat, np.repeat(per_word, sizes), BUCKETS)
        du = p["e"].T @ per_bucket
        gradients = {"e": np.outer(per_bucket, u), "u": np.stack([-du, du], axis=1), "b": np.array([bias_error])}
        gradients["e"] += DECAY * p["e"]
        for k, g in gradients.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.99 * s[k] + 0.01 * g * g
            p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)
    return Model(p["e"] @ (p["u"][:, 1] - p["u"][:, 0]), float(p["b"][0]))


def _sample(ids: DataFrame, n: int) -> list:
    """Of ``n`` ids, the ``SAMPLE`` with the smallest hash.

    A bound on the hash lets about twice as many through, so what the driver gets does not grow with the number of tasks.
    """
    order = F.xxhash64("doc_id")
    bound = F.lit(-(1 << 63) + (2 * SAMPLE << 64) // n) if n > 4 * SAMPLE else None
    for part in ([] if bound is None else [ids.where(order < bound)]) + [ids]:
        found = [r["doc_id"] for r in part.orderBy(order, "doc_id").limit(SAMPLE).collect()]
        if len(found) == min(SAMPLE, n):
            break
    return found


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``docs`` and labels (``doc_id``, ``label`` 0..1, one row an id).

    Ids are counted and chosen without their texts, which are read for the chosen ones alone.
    """
    known = docs.select("doc_id").distinct().join(labels.withColumnRenamed("doc_id", "__id"), F.col("doc_id") == F.col("__id"))
    known = known.select("doc_id", (F.col("label") >= 0.5).alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    toxic, clean = counts.get(True, 0), counts.get(False, 0)
    prior = math.log((toxic + 0.5) / (clean + 0.5)) if toxic + clean else 0.0
    if not toxic or not clean:
        return Model(np.zeros(BUCKETS), prior)
    chosen = [(i, side) for side, n in ((True, toxic), (False, clean)) for i in _sample(known.where(F.col("toxic") == side), n)]
    wanted = docs.sparkSession.createDataFrame(chosen, f"__id {id_type(docs)}, toxic boolean")
    # 2 * SAMPLE rows: their size is known, so they are sent to the texts and not the other way round.
    rows = docs.join(F.broadcast(wanted), F.col("doc_id") == F.col("__id"))
    sample = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("toxic", "doc_id").collect()
    texts = [r["text"] or "" for r in sample]
    if not any(words(t) for t in texts):
        return Model(np.zeros(BUCKETS), prior)
    model = train(texts, np.array([int(r["toxic"]) for r in sample]))
    # The classes weighed alike in training; all labelled rows say how common they are.
    return Model(model.lean, model.bias + prior)


def score(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``: learnt from labels (``doc_id``, ``label``) of rows not held out."""
    known = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("label").alias("label"))
    model = fit(docs.select("doc_id", "text").where(~held_out), known)
    shared = docs.sparkSession.sparkContext.broadcast((model.lean, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            scores = [own.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    everything = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return small_batches(everything).mapInArrow(
        run, f"doc_id {id_type(docs)}, held_out boolean, score double"
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
