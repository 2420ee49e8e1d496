"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule looks at a document's measures and votes good (+1) or bad (-1), or abstains (0), which tells as much as it is commoner among good or bad ones. How often each
rule is right among good and among bad documents, and the share of good ones, are estimated without labels from the counts
of the vote patterns, and a document is kept if its posterior probability of being good is at least
``threshold`` and the base rules did not fail.

All work on documents is DataFrame expressions. Only the counts of the vote patterns reach the
driver, at most 3 ** number of rules rows whatever the input.

Defined cases: a null or empty text has no words, so it fails the base rules (n_words < 10) and its
measures are 0. A null id is kept as null. Repeated rows are judged row by row, alike. An empty table
gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import keep_rows, materialise, word_array

WINDOW = 5
PRIOR = 20


@dataclass(frozen=True)
class Rule:
    """Votes ``vote`` where the SQL condition over the measures holds, and abstains elsewhere."""

    name: str
    vote: int
    when: str

    def column(self) -> Column:
        return F.when(F.expr(self.when), self.vote).otherwise(0).alias(f"vote_{self.name}")


RULES = (
    Rule("symbols", -1, "n_symbols >= 0.2 * n_words"),
    Rule("repeated_words", -1, "n_repeat_words >= 0.2 * n_words"),
    Rule("repeated_lines", -1, "n_dup_lines >= 0.3 * greatest(n_lines, 2)"),
    Rule("capitals", -1, "n_upper >= 0.4 * greatest(n_letters, 1)"),
    Rule("word_length", -1, "word_chars < 2.5 * n_words or word_chars > 14 * n_words"),
    Rule("letters", -1, "n_letters < 0.45 * word_chars"),
    Rule("shouting", -1, "n_exclamations >= 0.3 * n_words"),
    Rule("prose", 1, "n_letters >= 0.92 * word_chars and n_upper <= 0.2 * n_letters and n_words >= 10"),
)


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id``, the text hash and the measures of every document."""
    t = docs.select(
        "doc_id", F.xxhash64("text").alias("__text"), F.coalesce("text", F.lit("")).alias("t")
    )
    # A one-row generator binds each array once; the optimizer can't copy it into its uses.
    t = t.select("*", F.inline(F.array(F.struct(word_array(F.col("t")).alias("w")))))
    t = t.select(
        "doc_id",
        "__text",
        F.size("w").cast("long").alias("n_words"),
        _window_hashes(F.col("w")).alias("h"),
        F.length(F.translate("t", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        _count_of("t", "#*$%&|<>").alias("n_symbols"),
        _count_of("t", "!").alias("n_exclamations"),
        F.filter(F.split("t", "\n"), lambda x: F.translate(x, " \t\x0b\f\r", "") != "").alias("l"),
        F.length(F.regexp_replace("t", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
    )
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    pairs = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    t = t.select(
        "*",
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.inline(F.array(F.struct(F.when(repeats, pairs).alias("s")))),
    ).drop("l", "h")
    starts = F.sort_array(
        F.transform(
            F.filter("s", lambda p, i: (F.get("s", i - 1)["x"] == p["x"]) | (F.get("s", i + 1)["x"] == p["x"])),
            lambda p: p["i"],
        )
    )
    t = t.select("*", F.inline(F.array(F.struct(starts.alias("p"))))).drop("s")
    # A start covers five words, or fewer if the next start comes sooner.
    covered = F.aggregate(
        F.transform("p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - x, F.lit(WINDOW)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return t.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).drop("p")


def _count_of(column: str, characters: str) -> Column:
    return (F.length(column) - F.length(F.translate(column, characters, ""))).cast("long")


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash of each run of five words."""
    n = F.size(words) - (WINDOW - 1)
    return F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1),
            lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


@dataclass(frozen=True)
class LabelModel:
    """The share of good documents, and of each rule the share of its votes (-1, 0, 1) among bad and among good ones."""

    good: float
    given_bad: tuple[dict[int, float], ...]
    given_good: tuple[dict[int, float], ...]

    def weight(self, rule: int, vote: int) -> float:
        """What a vote adds to the log odds of being good; a rule is never read backwards."""
        weight = math.log(self.given_good[rule][vote] / self.given_bad[rule][vote])
        return max(0.0, weight) if vote > 0 else min(0.0, weight) if vote < 0 else weight

    def log_odds(self, pattern: Sequence[int]) -> float:
        return math.log(self.good / (1 - self.good)) + sum(self.weight(j, v) for j, v in enumerate(pattern))

    def posterior(self, votes: Sequence[Column]) -> Column:
        score = F.lit(math.log(self.good / (1 - self.good)))
        for j, vote in enumerate(votes):
            score = score + F.when(vote > 0, self.weight(j, 1)).when(vote < 0, self.weight(j, -1)).otherwise(self.weight(j, 0))
        return 1 / (1 + F.exp(-score))


def fit(patterns: dict[tuple[int, ...], int], n_rules: int, rounds: int = 30) -> LabelModel:
    """Expectation-maximisation over counted vote patterns.

    It starts from the belief that a document with a bad vote is bad with probability 0.9 and one without is good with 0.95. The share
    of good documents stays within 0.05..0.95. Every share is smoothed by what was believed at first, worth ``PRIOR`` votes.
    """
    belief = {p: 0.1 if -1 in p else 0.95 for p in patterns}
    model = LabelModel(0.7, ({-1: 0.3, 0: 0.5, 1: 0.2},) * n_rules, ({-1: 0.01, 0: 0.39, 1: 0.6},) * n_rules)
    start, total = model, sum(patterns.values())
    for _ in range(rounds if total else 0):
        good = sum(c * belief[p] for p, c in patterns.items()) / total
        shares = []
        for side, first in ((lambda p: 1 - belief[p], start.given_bad), (lambda p: belief[p], start.given_good)):
            mass = sum(c * side(p) for p, c in patterns.items()) + PRIOR
            shares.append(
                tuple(
                    {
                        v: (sum(c * side(p) for p, c in patterns.items() if p[j] == v) + PRIOR * first[j][v]) / mass
                        for v in (-1, 0, 1)
                    }
                    for j in range(n_rules)
                )
            )
        model = LabelModel(min(0.95, max(0.05, good)), *shares)
        belief = {p: 1 / (1 + math.exp(-max(-50.0, min(50.0, model.log_odds(p))))) for p in patterns}
    return model


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = 0.5) -> DataFrame:
    """Measures, votes, posterior and verdict of every row; ``__text`` is the hash of its text."""
    voted = materialise(
        measures(docs).select("*", *(r.column() for r in rules)), "quality-votes"
    )
    votes = [f"vote_{r.name}" for r in rules]
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    # What fails the base rules goes anyway; the weights are learnt from the rest.
    counted = voted.where(~base_failed).groupBy(*votes).count().collect()
    model = fit({tuple(r[v] for v in votes): r["count"] for r in counted}, len(rules))
    return voted.select(
        "*",
        base_failed.alias("base_failed"),
        model.posterior([F.col(v) for v in votes]).alias("p_good"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    kept = judge(docs).where("kept").select(F.col("doc_id").alias("__id"), "__text").distinct()
    return keep_rows(docs, kept)
