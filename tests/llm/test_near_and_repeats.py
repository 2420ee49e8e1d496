"""Near-duplicates and repeats against brute force, and on odd input."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from zonecast.llm import near_dedup, substring_dedup
from zonecast.llm.components import components


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected_components(rows):
    """Smallest reachable id by comparing every pair."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            shared = len(a & b)
            if a and b and 100 * shared >= 75 * (len(a) + len(b) - shared):
                p, q = top(i), top(j)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), top(i)) for i in ids}


def expected_kept(rows):
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        for j in range(len(w) - 49):
            first.setdefault(tuple(w[j : j + 50]), i)
    out = []
    for i, t in rows:
        w = words(t)
        keep = [True] * len(w)
        for j in range(len(w) - 49):
            if first[tuple(w[j : j + 50])] < i:
                keep[j : j + 50] = [False] * 50
        text = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        out.append((i, len(w), keep.count(False), hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def test_components_of_documents_and_near_copies(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    long = max(rows, key=lambda r: len(r[1]))[1].split(" ")
    # A chain of near copies, each one change further, whose ends are unlike each other.
    for k in range(40):
        long = long[: 10 * k] + ["changed"] + long[10 * k + 1 :]
        rows.append((100_000 + k, " ".join(long)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def templated_pairs(pairs, seed=5):
    """Documents from one template, each at a similarity of exactly 0.75 to its partner and of about 0.6 to all others."""
    rng = random.Random(seed)
    rows = []
    for pair in range(pairs):
        places = rng.sample(range(5, 210, 5), 8)
        for side, own in enumerate((places[2:5], places[5:])):
            changed = {**{p: f"pair{pair}at{p}" for p in places[:2]}, **{p: f"own{pair}side{side}at{p}" for p in own}}
            rows.append((2 * pair + side, " ".join(changed.get(i, f"word{i}") for i in range(214))))
    return rows


def test_links_in_a_group_of_alike_documents(spark):
    rows = templated_pairs(20)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    wanted = expected_components(rows)
    assert sum(top != i for i, (_, top) in wanted.items()) >= 20
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted


def linked_pairs(texts, chunk=200):
    """Every pair of texts with a similarity of 0.75 or more, by the shingles that both hold."""
    index = {}
    sets = [sorted({index.setdefault(x, len(index)) for x in shingles(t)}) for t in texts]
    held = np.zeros((len(texts), len(index)), np.float32)
    for row, own in zip(held, sets, strict=True):
        row[own] = 1
    n = held.sum(axis=1)
    for a in range(0, len(texts), chunk):
        shared = held[a : a + chunk] @ held.T
        x, y = np.nonzero(100 * shared >= 75 * (n[a : a + chunk, None] + n[None] - shared))
        yield from ((int(i) + a, int(j)) for i, j in zip(x, y, strict=True) if i + a < j)


def test_recall_in_a_large_templated_group(spark):
    """2,000 alike documents, 1,000 links of exactly 0.75 among two million pairs: more than a node is compared at, so it branches."""
    rows = templated_pairs(1000)
    wanted = set(linked_pairs([t for _, t in rows]))
    assert wanted >= {(2 * k, 2 * k + 1) for k in range(1000)}
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    component = {r.doc_id: r.component_id for r in found}
    missed = [p for p in wanted if component[p[0]] != component[p[1]]]
    assert len(missed) <= len(wanted) // 1000
    joined = {(component[a], component[b]) for a, b in wanted}
    assert sum(len({i for i in pair}) == 1 for pair in joined) and len(set(component.values())) >= len(rows) - len(wanted)


def test_cells_hold_every_pair_once_or_more(spark, monkeypatch):
    """Nodes dealt into many cells, outsiders in parts of their own: each outsider meets every other document of its node."""
    monkeypatch.setattr(near_dedup, "SMALL", 7)
    rows = [(node, i, 10, 0 if i % 5 else i, 0) for node, size in ((1, 40), (2, 3), (3, 1)) for i in range(size)]
    table = spark.createDataFrame(rows, "node long, id long, n long, component long, main long").selectExpr(
        "*", "count(*) over (partition by node) size", "sum(n) over (partition by node) volume",
        "count_if(component <> main) over (partition by node) others", "sum(if(component <> main, n, 0)) over (partition by node) other_volume",
    )
    met, sizes = set(), Counter()
    for _, cell in pd.DataFrame([r.asDict() for r in near_dedup._cells(table).collect()]).groupby(["node", "cell"]):
        sizes[len(cell) // 10] += 1
        met |= {(r.node, r.id, m) for r in cell[cell.outside].itertuples() for m in cell[cell.member].id}
    assert met == {(node, i, m) for node, i, _, c, main in rows if c != main for n, m, *_ in rows if n == node}
    assert max(sizes) <= 2


@pytest.mark.parametrize("depth", [1, 7, 10])
def test_trees_hold_pairs_of_least_similarity_at_every_depth(depth):
    rng = np.random.default_rng(depth)
    trees, shares = near_dedup.TREES[depth], []
    for _ in range(200):
        both = rng.integers(0, 2**63, 240).astype(np.uint64)  # 180 of 240 are shared: exactly 0.75
        a, b = both[:210], np.concatenate([both[:180], both[210:]])
        nodes = [np.concatenate([_below(k, depth, x) for k in range(1, depth + 1)]) for x in (a, b)]
        shared = np.unique(np.intersect1d(*nodes) & near_dedup.TREE_BITS)
        shares.append(len(shared) / trees)
    assert min(shares) > 0
    assert abs(np.mean(shares) - near_dedup._share(depth)) < 0.03


def _below(start, depth, shingles):
    nodes = near_dedup.entered(start, shingles)
    for d in range(start + 1, depth + 1):
        nodes = near_dedup.children(nodes, d, shingles)
    return nodes


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    found = near_dedup.near_duplicates(odd_docs).collect()
    assert len(found) == 16
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[2].component_id == 1 and not by_id[2].kept
    assert by_id[10].component_id == 9 and by_id[9].n_shingles == 1
    assert by_id[12].component_id == 7
    assert all(by_id[i].kept and by_id[i].n_shingles == 0 for i in (3, 4, 5))
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    kept = near_dedup.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 9, 11, 13]
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_tasks_follow_the_documents_not_the_shuffle_partitions(spark, documents, monkeypatch):
    """Few documents in a session of many shuffle partitions, which nothing joins later: no stored table has a file for each of them."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, files, store = {k: spark.conf.get(k) for k in held}, [], near_dedup.Scratch.store

    def counted(work, df, name):
        stored = store(work, df, name)
        files.append((name, len(stored.inputFiles())))
        return stored

    monkeypatch.setattr(near_dedup.Scratch, "store", counted)
    docs = documents.select("doc_id", "text")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = near_dedup.near_duplicates(docs)
        files.append(("near-duplicates", len(found.inputFiles())))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {"classes", "class-rows", "nodes", "node-rows"} <= {name for name, _ in files}
    assert max(n for _, n in files) <= 2 * spark.sparkContext.defaultParallelism < 64
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == expected_components(rows)


@pytest.mark.parametrize("group", [0, 40, substring_dedup.GROUP])
def test_repeats_equal_brute_force(documents, group):
    """By trees alone, by lengthened prefixes alone, and by both."""
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = substring_dedup.digests(substring_dedup.remove_repeats(documents, group)).collect()
    assert Counter(map(tuple, found)) == expected_kept(rows)


def test_texts_that_share_an_id_lose_what_they_repeat_themselves(spark):
    p, q, r = (" ".join(f"{x}{i}" for i in range(80)) for x in "pqr")
    rows = [(1, p), (2, p), (2, q), (2, f"{q} {r}"), (3, r), (3, f"x {p} y"), (3, f"x {p} y"), (4, p.replace(" ", "  ")), (4, f"{r[:100]} z")]
    found = substring_dedup.digests(substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert Counter(map(tuple, found)) == expected_kept(rows)
    assert sum(r.n_removed == 0 for r in found if r.doc_id == 2) == 2


def longest_repeats(rows):
    """(id, first word, words) of each run of starts whose windows start in a smaller id too."""
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        for j in range(len(w) - 49):
            first.setdefault(tuple(w[j : j + 50]), i)
    out = []
    for i, t in rows:
        w, run = words(t), []
        hits = [j for j in range(len(w) - 49) if first[tuple(w[j : j + 50])] < i]
        for j in hits:
            if run and j == run[-1] + 1:
                run[-1] = j
            else:
                run += [j, j]
        out += [(i, a, b - a + 50) for a, b in zip(run[::2], run[1::2], strict=True)]
    return sorted(out)


@pytest.mark.parametrize("group", [0, 40, substring_dedup.GROUP])
def test_maximal_repeats(documents, group):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = substring_dedup.maximal_repeats(documents, group).collect()
    assert sorted((r.doc_id, r.start, r.length) for r in found) == longest_repeats(rows)


def test_subtree_orders_suffixes_and_tells_what_they_share():
    rng = np.random.default_rng(2)
    stretches = [rng.integers(0, 2, 50 + k).astype(np.uint64) for k in (0, 3, 9)] + [np.zeros(54, np.uint64)]
    stretches.append(stretches[2][4:58].copy())
    tree = substring_dedup.Subtree(stretches)
    suffixes = [stretches[s][o : o + 50].tobytes() for s, o in zip(tree.stretch, tree.offset, strict=True)]
    assert len(suffixes) == 1 + 4 + 10 + 5 + 5
    placed = [suffixes[k] for k in tree.order]
    assert placed == sorted(suffixes)
    for a, b, shared in zip(placed, placed[1:], tree.shared.tolist(), strict=False):
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        assert shared == (50 if a == b else int((x != y).argmax()))
    owner = np.array([3, 1, 0, 2, 4])
    least = {}
    for k, x in enumerate(suffixes):
        least[x] = min(least.get(x, 9), owner[tree.stretch[k]])
    assert tree.repeated(owner).tolist() == [bool(owner[tree.stretch[k]] > least[x]) for k, x in enumerate(suffixes)]


def test_repeats_of_odd_rows(odd_docs, no_docs):
    found = substring_dedup.remove_repeats(odd_docs).collect()
    with_id = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in found if r.doc_id]
    assert Counter(with_id) == expected_kept([(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id])
    assert all(r.n_removed == 0 for r in found if r.doc_id is None)
    cut = substring_dedup.rewrite(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == 16
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[8] == "other end" and texts[12] == "" and texts[3] is None and texts[5] == " \t\n"
    assert substring_dedup.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(30)], [(0, i) for i in range(1, 40)] + [(50, 51), (51, 52)]])
def test_components(spark, links):
    parent = {x: x for link in links for x in link}
    for _ in parent:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.component for r in found} == parent


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(30)], [(0, i) for i in range(1, 40)] + [(50, 51), (51, 52)]])
def test_components_by_rounds(spark, links, monkeypatch):
    at_once = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    monkeypatch.setattr("zonecast.llm.components.AT_ONCE", 0)
    assert {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()} == at_once


def test_a_few_links_take_a_few_jobs(spark):
    """A chain of any length below the limit: no rounds of shuffles over next to nothing."""
    chain = spark.createDataFrame([(f"{i:04}", f"{i + 1:04}") for i in range(500)], "a string, b string")
    spark.sparkContext.setJobGroup("few-links", "components of a chain")
    try:
        found = components(chain)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-links")) <= 6
    assert {(r.id, r.component) for r in found.collect()} == {(f"{i:04}", "0000") for i in range(501)}


def test_links_found_below_large_nodes(spark, monkeypatch):
    """Nodes of a few documents count as large and branch; what is found then is the same."""
    monkeypatch.setattr(near_dedup, "SMALL", 8)
    rows = templated_pairs(8) + [(100 + k, f"copy{k} " + " ".join(f"word{i}" for i in range(200))) for k in range(30)]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected_components(rows)


def test_a_window_of_many_documents_is_dealt_once_a_part(spark):
    """A passage that 600 documents share: as many rows as its windows and the edges ask for, not a row a document and window."""
    passage = " ".join(f"shared{i}" for i in range(120))
    rows = [(i, f"own{i} {passage} end{i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    wide = docs.select("doc_id").distinct().count()
    prefixes = substring_dedup.survey(docs).selectExpr("doc_id id", "__text of", "cast(array() as array<long>) narrow", "prefixes wide")
    dealt = substring_dedup._lengthen(docs, prefixes).collect()
    assert sum(len(r.places) for r in dealt) == wide * (122 - 49)
    assert len(dealt) < 600 * 3 + 71 * 20
    found = substring_dedup.digests(substring_dedup.remove_repeats(docs, 40)).collect()
    assert Counter(map(tuple, found)) == expected_kept(rows)


def test_word_hashes_tell_words_apart():
    import numpy as np

    from zonecast.llm.wordhash import Words, runs

    texts = ["abc acb bac bca cab cba aabb abab baba", "x" * 70_000, "abc", "", "é é ab c"]
    found = Words(texts)
    assert len(np.unique(found.hashes)) == len({w for t in texts for w in words(t)})
    assert found.hashes[0] == Words(["abc"]).hashes[0] == found.hashes[10]
    assert Words(["ABC É"], lower=True).hashes.tolist() == Words(["abc É"]).hashes.tolist()
    many = np.random.default_rng(1).integers(0, 2**63, 400).astype(np.uint64)
    assert len(np.unique(runs(many, 50))) == 351 and runs(many, 50)[7] == runs(many[7:57], 50)[0]
