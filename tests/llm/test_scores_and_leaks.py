"""Held-out accuracy of the classifiers, planted benchmark passages, and odd input."""

import random
import time
import zlib

import pytest

from zonecast.llm import decontaminate, licenses, quality_classifier, queries, toxicity

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    ("name", "label", "sf_dir", "least"),
    # A hundredth of the tables holds too few toxic documents to measure anything.
    [("op6_fourier_quality", "quality", SF_DIR, 0.95), ("op7_subword_toxicity", "toxic", "/root/testdata/sf0.1", 0.9)],
)
def test_held_out_scores(spark, name, label, sf_dir, least):
    found = queries.QUERIES[name][0](spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count() and all(0 <= r.score <= 1 for r in found)
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    modulus, rest = (5, 0) if label == "quality" else (4, 2)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest)
        assert r.predicted == int(r.score >= 0.3)
    good = [r.score for r in found if r.held_out and labels.get(r.doc_id) == 1]
    bad = [r.score for r in found if r.held_out and labels.get(r.doc_id) == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert wins / (len(good) * len(bad)) >= least


@pytest.mark.parametrize("operator", [quality_classifier, toxicity])
def test_scores_of_odd_rows(spark, odd_docs, no_docs, operator):
    schema = "doc_id long, label double"
    some = spark.createDataFrame([(1, 1.0), (1, 0.0), (6, 0.0), (7, 1.0), (None, 1.0), (8, None), (2, 1.0)], schema)
    fold = quality_classifier.remainder(4) == 2
    extra = (quality_classifier.remainder(5) == 1,) if operator is quality_classifier else ()
    for labels in (some, some.limit(0), some.where("label = 1")):
        found = operator.score(odd_docs, labels, fold, *extra).collect()
        assert len(found) == 16
        assert all(r.score is not None and 0 <= r.score <= 1 and r.held_out is not None for r in found)
    assert operator.score(no_docs, some, fold, *extra).count() == 0


def test_toxicity_reads_long_words_whole_and_every_neighbouring_pair():
    import numpy as np

    def lean(*bad):
        out = np.zeros(toxicity.BUCKETS)
        out[[b for w in bad for b in toxicity.subwords(w)]] = 5
        return toxicity.Model(out, 0.0)

    model, run = lean("vilest"), "-".join(["word"] * 30)
    assert model.score(f"{run}-vilest-{run}") > model.score(f"{run}-word-{run}")
    long = "abcdefghij" * 9 + "klm"
    blocks = toxicity.words(long)
    assert {long[i : i + 5] for i in range(len(long) - 4)} == {b[i : i + 5] for b in blocks for i in range(len(b) - 4)}
    model = lean("vile", "hound")
    assert model.score("one two vile hound") == model.score("one vile hound two") == model.score("one vile hound")


def test_pooling_is_monotone():
    import numpy as np

    levels = quality_classifier.pool(np.array([0.0, 3, 1, 2, 5]), np.array([2.0, 4, 4, 3, 5]))
    assert np.allclose(levels, [0, 0.5, 0.5, 2 / 3, 1])


def test_tiles_are_longest_first_and_do_not_overlap():
    item = "a b c d e f g h i j k l".split()
    parts = ["x g h i j k l y".split(), "a b c d e f g h".split()]
    tiles = decontaminate.tile(item, parts, 3)
    assert sorted(k for *_, k in tiles) == [4, 8] or sorted(k for *_, k in tiles) == [6, 6]
    assert sum(k for *_, k in tiles) == 12
    assert decontaminate.tile(["a"] * 9, [["a"] * 5], 3)[0][2] == 5
    assert decontaminate.tile(item, [], 3) == []


def test_planted_passages(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    w = items[0].text.split(" ")
    half = len(w) // 2
    rows = [
        (1, "before it " + items[0].text.upper().replace(",", ";") + " after"),
        (2, " ".join(w[half:]) + " something else between " + " ".join(w[:half])),
        (3, "nothing of it is here, and nothing more than that"),
        (4, " ".join(w[:4])),
        (None, items[0].text),
        (5, None),
        (6, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(r.item_id, r.text) for r in items] + [(None, "x"), (-1, None), (-2, "too short")], "item_id long, text string")
    found = decontaminate.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, items[0].item_id), (2, items[0].item_id)}
    assert [r.doc_id for r in decontaminate.clean(docs, bench).orderBy("doc_id").collect()] == [None, 3, 4, 5, 6]
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_licenses(spark, no_docs):
    rows = [
        (1, "Some prose here.\nReleased under the MIT License.\nMore prose."),
        (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, "He wrote about the sea and the land."),
        (4, None),
        (5, ""),
        (None, "Licensed under CC BY-NC 4.0."),
        (6, "Licensed under the Apache License, Version 2.0."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.paragraph): r for r in licenses.scan(spark, docs).collect()}
    assert {k: r.family for k, r in found.items()} == {(1, 1): "mit", (2, 0): "gpl", (None, 0): "cc-by-nc", (6, 0): "apache-2.0"}
    assert all(r.confirmed for r in found.values())
    assert licenses.scan(spark, no_docs).count() == 0


def tiled_plainly(item, parts, least=5):
    """Every pair of positions compared word by word, the longest match marked, and all over again."""
    other = [w for part in parts for w in [*part, None]]
    free_a, free_b, tiles = [True] * len(item), [True] * len(other), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(other)):
                k = 0
                while i + k < len(item) and j + k < len(other) and item[i + k] == other[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return tiles
        free_a[i : i + k] = free_b[j : j + k] = [False] * k
        tiles.append((i, j, k))


@pytest.mark.parametrize("seed", range(40))
def test_tiles_equal_brute_force(seed):
    rng = random.Random(seed)
    words = "abcdefgh"[: rng.randint(1, 8)]
    item = [rng.choice(words) for _ in range(rng.randint(1, 30))]
    parts = []
    for _ in range(rng.randint(1, 4)):
        at = rng.randrange(len(item))
        parts.append([rng.choice(words) for _ in range(rng.randint(0, 6))] + item[at : at + rng.randint(1, 20)])
    assert decontaminate.tile(item, parts) == tiled_plainly(item, parts)


def test_one_word_repeated_is_tiled_in_no_time():
    started = time.monotonic()
    assert decontaminate.tile(["no"] * 200, [["no"] * 100_000]) == [(0, 0, 200)]
    assert time.monotonic() - started < 20


def test_coverage_equals_brute_force_over_all_pairs(spark):
    """Few words and many repeats, so that pairs just below and just above the threshold abound; some ids repeat."""
    rng = random.Random(8)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(3, 24)))) for i in range(12)]
    docs = []
    for d in range(60):
        own = rng.choice(items)[1].split()
        at = rng.randrange(len(own))
        docs.append((d % 55, " ".join([rng.choice("abcdefgh") for _ in range(8)] + own[at : at + rng.randint(3, 20)] + [f"own{d}"])))
    docs.append((None, items[0][1]))
    tables = [spark.createDataFrame(rows, f"{name} long, text string") for rows, name in ((docs, "doc_id"), (items, "item_id"))]
    expected, dirty = {}, set()
    for d, text in docs:
        for i, item in items:
            covered = sum(k for *_, k in tiled_plainly(item.split(), [text.split()])) if d is not None else 0
            if covered and covered >= 0.5 * len(item.split()):
                expected[d, i] = max(expected.get((d, i), 0), covered / len(item.split()))
                dirty.add((d, text))
    found = decontaminate.contaminated(*tables).collect()
    assert {(r.doc_id, r.item_id): r.coverage for r in found} == pytest.approx(expected) and len(found) == len(expected)
    left = decontaminate.clean(*tables).collect()
    assert sorted(map(tuple, left), key=str) == sorted((r for r in docs if r not in dirty), key=str)
