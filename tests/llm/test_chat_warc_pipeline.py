"""Round trips of chats and archives, and the pipeline against its own parts."""

import base64
import hashlib

import corpus_pipeline
import duckdb
import zstandard
from compare import differences, oracle_connection
from hypothesis import given, settings
from hypothesis import strategies as st

from zonecast.llm import chat, queries, warc

SF_DIR = "/root/testdata/sf0.001"


def test_chat_query_equals_its_sql(spark):
    query, sql = queries.QUERIES["op8_chat_format"]
    assert differences(query(spark, SF_DIR), oracle_connection(SF_DIR), sql) == []


def test_chats_read_back(spark):
    pieces = ["<", "[", "/", "s>", "INST]", "\\", "</s>", "[INST] ", " [/INST] ", "a", "\n", "$1", ""]
    texts = [a + b + c for a in pieces for b in pieces for c in pieces]
    roles = ["user", "assistant", "</s>", None, " [/INST] x"]
    rows = [(i // 4, i % 4, roles[i % 5], t, "extra") for i, t in enumerate(texts)]
    rows += [(10_000, None, "user", None, None), (None, 1, "user", "x", None), (10_001, 1, "user", "b", None), (10_001, 1, "user", "a", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    read = {r.conv_id: [tuple(x) for x in r.turns] for r in chat.parse(chat.format_conversations(turns)).collect()}
    for i in range(len(texts) // 4):
        assert read[i] == [(r or "", t) for _, _, r, t, _ in rows[4 * i : 4 * i + 4]]
    assert read[10_000] == [("user", "")] and read[None] == [("user", "x")] and read[10_001] == [("user", "a"), ("user", "b")]
    assert chat.digests(chat.format_conversations(turns.limit(0))).count() == 0


def test_turn_order(spark):
    orders = {1: "sua", 2: "ua", 3: "uau", 4: "au", 5: "uu", 6: "s", 7: "us", 8: "xu"}
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows = [(c, t, names[x], "") for c, order in orders.items() for t, x in enumerate(order)]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.conv_id for r in made.collect() if r.valid} == {1, 2, 3}


def test_archives_read_back(spark):
    rows = [(i, f"http://x/{i}", "same" * 50 if i % 3 else f"page {i} " * 40) for i in range(60)]
    rows += [(100, None, None), (101, "http://x\r\ny", ""), (None, "u", "same" * 50), (None, "u", "alone"), (59, "again", "same" * 50)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    largest = {}
    for i, _, html in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", -1))
    expected = []
    for i, _, html in rows:
        payload = (html or "").encode()
        head = largest.get(html or "")
        response = head is None or i == head
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected.append((i, len(payload), digest, "response" if response else "revisit", None if response else head))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, warc.round_trip(pages).collect()), key=key) == sorted(expected, key=key)
    assert warc.round_trip(pages.limit(0)).count() == 0
    assert {r.record_type for r in warc.round_trip(pages, least_bytes=10_000).collect()} == {"response"}


def test_an_archive_starts_with_its_dictionary(tmp_path):
    records = [warc.record(i, f"http://x/{i}", f"<html>page {i} of the site</html>".encode() * 20, None, False) for i in range(400)]
    path = str(tmp_path / "a.warc.zst")
    warc.write_archive(path, records)
    raw = (tmp_path / "a.warc.zst").read_bytes()
    assert int.from_bytes(raw[:4], "little") == warc.DICTIONARY_MAGIC
    size = int.from_bytes(raw[4:8], "little")
    words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size]))
    first = zstandard.ZstdDecompressor(dict_data=words).decompressobj().decompress(raw[8 + size :])
    assert first == records[0]
    assert len(list(warc.read_archive(path))) == 400


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(max_size=60), max_size=20))
def test_any_payload_survives(tmp_path_factory, payloads):
    path = str(tmp_path_factory.mktemp("w") / "a.warc.zst")
    warc.write_archive(path, [warc.record(i, None, p, None, False) for i, p in enumerate(payloads)])
    assert [b.partition(b"\r\n\r\n")[2] for _, b in warc.read_archive(path)] == payloads


def test_pipeline_stages_agree_with_brute_force(spark):
    from test_near_and_repeats import expected_components, expected_kept, words
    from test_tokens_and_rules import measures

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, SF_DIR)
        after = docs.collect()
        rows = [(r.doc_id, r.text) for r in before]
        ids = sorted(r.doc_id for r in after)
        if name == "quality_rules":
            base = {i for i, t in rows if (m := measures(t))[0] >= 10 and 100 * m[4] <= 20 * m[0]}
            assert set(ids) <= base and len(ids) > 0.8 * len(base)
        elif name == "near_dedup":
            assert ids == sorted(i for i, (_, c) in expected_components(rows).items() if i == c)
        elif name == "substring_dedup":
            removed = {i: n for (i, _, n, _) in expected_kept(rows)}
            assert {r.doc_id: len(words(r.text)) for r in after} == {i: len(words(t)) - removed[i] for i, t in rows}
            assert all(r.n_chars == len(r.text) for r in after if removed[r.doc_id])
        elif name == "decontamination":
            items = duckdb.sql(f"select text from '{SF_DIR}/benchmark.parquet'").fetchall()
            assert ids == sorted(i for i, t in rows if not any(x in t for (x,) in items))
        if name != "byte_bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(after, docs.schema)
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(ids)
