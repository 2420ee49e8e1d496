"""Line dedup, source divergence and lexical search against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import differences, oracle_connection

from zonecast.llm import divergence, lexical_search, line_dedup
from zonecast.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op11_block_max_search", "op12_quadtree_divergence", "op13_line_bitmaps"])
def test_query_equals_its_sql(spark, name):
    query, sql = QUERIES[name]
    assert differences(query(spark, "/root/testdata/sf0.001"), oracle_connection("/root/testdata/sf0.001"), sql) == []


def dedup_plainly(rows, least_chars=20, least_docs=3):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    for doc_id, text in rows:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= least_chars:
                    holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line for line in lines if doc_id is None or len(holders[key(line)]) < least_docs or doc_id == max(holders[key(line)])
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_lines_of_odd_documents(spark, odd_docs, no_docs):
    line = "a line of twenty code points"
    more = [
        (20, f"{line}\nown\n  {line.upper()}\t\n\n"),
        (21, f"{line}\r\n{'é' * 19}\n{'É' * 20}"),
        (22, f"{line}\n{line}\n{line}"),
        (22, f"other\n{line}"),
        (23, f"{'É' * 20}\n{'é' * 20}"),
        (24, "É" * 20),
        (None, line),
    ]
    docs = odd_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = line_dedup.digests(line_dedup.deduplicate_lines(docs)).collect()
    assert sorted(map(tuple, got), key=str) == dedup_plainly(rows)
    assert line_dedup.deduplicate_lines(no_docs).collect() == []


def test_a_line_that_is_cut_over_many_partitions(spark):
    hot = "this very line is in a third of all documents"
    rng = np.random.default_rng(5)
    pool = [f"line number {i} of a pool of lines" for i in range(300)]
    rows = [(int(i), "\n".join([hot] * int(i % 3 == 0) * 2 + rng.choice(pool, 3).tolist() + [f"own line of document {i}"])) for i in range(900)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = line_dedup.digests(line_dedup.deduplicate_lines(docs)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got), key=str) == dedup_plainly(rows)


@pytest.mark.parametrize("seed", range(30))
def test_stream_of_any_cuts_and_batches(seed):
    """The streams of arbitrary partitions and batches together decide as a look at all rows does."""
    rng = np.random.default_rng(seed)
    least = int(rng.integers(2, 5))
    rows = sorted(
        ((int(rng.integers(4)), 0, int(rng.integers(7)), 0, at) for at in range(int(rng.integers(1, 60)))), key=lambda r: (r[0], -r[2], r[4])
    )
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("__text", pa.int64()), ("at", pa.int32())])
    cuts = sorted(rng.integers(0, len(rows) + 1, int(rng.integers(0, 5))).tolist())
    dropped, undecided, firsts = [], [], defaultdict(set)
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        stream, told = line_dedup._Stream(least), []
        at = a
        while at < b:
            n = int(rng.integers(1, 9))
            part = rows[at : min(b, at + n)]
            told += stream.feed(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema))
            at += n
        told += stream.end(schema)
        for r in [r for t in told for r in t.to_pylist()]:
            if r["kind"] == line_dedup.DROPPED:
                dropped.append((r["h1"], r["at"]))
            elif r["kind"] == line_dedup.OPEN:
                undecided.append(r)
            else:
                firsts[r["h1"]].add(r["doc_id"])
    dropped += [(r["h1"], r["at"]) for r in undecided if len(firsts[r["h1"]]) >= least and r["doc_id"] < max(firsts[r["h1"]])]
    holders = defaultdict(set)
    for h, _, d, _, _ in rows:
        holders[h].add(d)
    expected = [(h, at) for h, _, d, _, at in rows if len(holders[h]) >= least and d < max(holders[h])]
    assert sorted(dropped) == sorted(expected)


def test_bitmaps_are_compressed_bits(spark):
    line = "the same line in all three documents"
    docs = spark.createDataFrame([(1, f"a\n{line}\n{line}\nb"), (2, line), (3, line)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in line_dedup.keep_bitmaps(docs).collect()}
    assert np.unpackbits(np.frombuffer(zlib.decompress(rows[1]["keep"]), np.uint8), count=4).tolist() == [1, 0, 0, 1]
    assert [rows[i]["n_dropped"] for i in (1, 2, 3)] == [2, 1, 0]


def audit_plainly(rows, least_docs=3, top=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    tokens = [(g, s, re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t.translate(LOWER))) for g, s, t in rows]
    holders, counts, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for g, s, terms in tokens:
        holders[g].update(set(terms))
        counts[g, s].update(terms)
        langs[g].add(s)
    out = []
    for g, sources in langs.items():
        kept = [t for t, n in holders[g].items() if n >= least_docs]
        n = {s: sum(counts[g, s][t] for t in kept) for s in sources}
        price = lambda c, total: 1 + 10**9 * (c + 1) // (total + len(kept))  # noqa: B023, E731
        p = {s: {t: price(counts[g, s][t], n[s]) for t in kept} for s in sources}
        whole = {t: price(sum(counts[g, s][t] for s in sources), sum(n.values())) for t in kept}
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - whole[t]) ** 2 // whole[t]) for t in kept if counts[g, s][t] and p[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(g, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def audited(docs, **kwargs):
    cols = ("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r[c] for c in cols) for r in divergence.audit(docs, **kwargs).collect())


def test_divergence_of_odd_documents(spark, odd_docs, no_docs):
    more = [("xx", f"s{i}", t) for i in range(3) for t in ("Ünï code ünÏ", "code CODE a_b", "12 34", None, "")]
    more += [("yy", "only", "no term is in three documents"), ("yy", "second", None), ("zz", "alone", "x")]
    docs = odd_docs.unionByName(spark.createDataFrame(more, "lang string, source string, text string"), allowMissingColumns=True)
    assert audited(docs) == audit_plainly([(r["lang"], r["source"], r["text"]) for r in docs.collect()])
    assert audited(no_docs) == []


def test_divergence_over_many_groups_and_blocks(spark):
    """More groups than a tile and more terms than a block, with most quadrants empty."""
    rng = np.random.default_rng(3)
    letters = str.maketrans("0123456789", "abcdefghij")
    rows = []
    for i in range(600):
        source = int(rng.integers(21))
        words = [f"w{source}x{int(k)}" for k in rng.integers(0, 8, 5)] + [f"all{int(k)}" for k in rng.zipf(1.5, 5) if k < 50]
        rows.append(("l", f"s{source}", " ".join(words).translate(letters)))
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert audited(docs, top=7, block=40, tile=8) == audit_plainly(rows, top=7)


@pytest.mark.parametrize("shape", [(1, 1), (1, 7), (5, 1), (6, 100), (8, 3)])
def test_joint_traversal_equals_the_dense_sums(shape):
    rng = np.random.default_rng(shape[0])
    counts = rng.integers(0, 10**12, shape) * (rng.random(shape) < 0.15)
    totals = counts.sum(axis=1) + shape[1]
    r, c = np.nonzero(counts)
    tree = divergence.Quadtree(r, c, counts[r, c], *shape)
    marks = np.ones(shape[0], bool)
    got = divergence.traverse(tree, totals, marks, marks)
    p = [[1 + 10**9 * (int(x) + 1) // int(n) for x in row] for row, n in zip(counts, totals, strict=True)]
    assert got.tolist() == [[sum((a - b) ** 2 // b for a, b in zip(x, y, strict=True)) for y in p] for x in p]


def search_plainly(docs, items, top=10):
    terms = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    held = [(d, Counter(terms(t))) for d, t in docs if d is not None and terms(t)]
    total, n_docs = sum(sum(c.values()) for _, c in held), len(held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(Counter)
    for i, t in items:
        if i is not None:
            asked[i].update(terms(t))
    out = []
    for i, of in asked.items():
        found = []
        for d, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            score = sum(
                k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, k in of.items()
                if t in c
            )
            found += [(score, d)] if score > 0 else []
        ranked = sorted(found, key=lambda x: (-x[0], x[1]))[:top]
        out += [(i, k, d, score) for k, (score, d) in enumerate(ranked, 1)]
    return sorted(out)


def searched(docs, items, **kwargs):
    return sorted(tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in lexical_search.search(docs, items, **kwargs).collect())


def test_search_of_odd_documents(spark, odd_docs, no_docs):
    items = [(1, "ALPHA beta beta"), (2, None), (3, ""), (4, "two, words!"), (4, "other"), (None, "alpha"), (5, "nowhere-found"), (6, "word1 x1")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert searched(odd_docs, asked) == search_plainly(rows, items)
    assert searched(no_docs, asked) == []
    assert searched(odd_docs, asked.where("false")) == []


def test_search_over_shards_blocks_and_windows(spark):
    """Small shards, blocks, windows and blocks of queries: bounds cut much, ties abound, results stay those of a full scan."""
    sizes = lexical_search.Sizes(shard=4000, postings=4, window=16, queries=3)
    rng = np.random.default_rng(11)
    word = lambda: f"t{min(int(rng.zipf(1.4)), 400)}"
    docs = [(int(i), " ".join(word() for _ in range(int(rng.integers(1, 30))))) for i in rng.permutation(1500)]
    docs += [(5000 + i, docs[i % 40][1]) for i in range(300)]
    items = [(i, " ".join(word() for _ in range(int(rng.integers(1, 12))))) for i in range(10)]
    docs_table, items_table = (spark.createDataFrame(t, f"{k} long, text string") for t, k in ((docs, "doc_id"), (items, "item_id")))
    got = searched(docs_table, items_table, sizes=sizes)
    assert got == search_plainly(docs, items)


def test_bounds_keep_blocks_closed(spark):
    """A frequent cheap term beside a rare dear one: most blocks of the frequent one are never decompressed."""
    measure = lexical_search.Measure(20_000, 200_000)
    shard = lexical_search._Shard()
    for i in range(20_000):
        shard.add(i, b"common filler words here" + (b" rare" if i % 1500 == 0 else b""))
    lists = []
    for name, df, lasts, bounds, blocks, _ in shard.rows(128):
        weight = measure.weight(df)
        ceiling = weight * int(measure.block_maxima(bounds).max())
        if name in (b"common", b"rare"):
            lists.append((1, lexical_search._List(measure, weight, ceiling, lasts, bounds, blocks)))
    best = lexical_search.best_of_shard(lists, np.arange(20_000))
    assert [d for d, _ in best] == [1500 * k for k in range(10)]
    opened = {len(of.blocks): len(of.open) for _, of in lists}
    assert opened[157] < 40
