"""The registered queries of the text operators: name -> (Spark query, comparison SQL or None)."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import (
    bpe,
    chat,
    decontaminate,
    divergence,
    lexical_search,
    licenses,
    line_dedup,
    near_dedup,
    quality_classifier,
    quality_rules,
    substring_dedup,
    toxicity,
    warc,
)
from zonecast.llm.common import read


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, read(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_decode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(encoded)


def op3_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents")).drop("__text")


def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.remove_repeats(read(spark, sf_dir, "documents")))


def _labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return read(spark, sf_dir, "labels").select("doc_id", F.col(label).cast("double").alias("label"))


def op6_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = quality_classifier.remainder(5)
    docs, labels = read(spark, sf_dir, "documents"), _labels(spark, sf_dir, "quality")
    return quality_classifier.score(docs, labels, remainder == 0, remainder == 1)


def op7_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), _labels(spark, sf_dir, "toxic")
    return toxicity.score(docs, labels, quality_classifier.remainder(4) == 2)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # The extra conversation says the template's own control strings.
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.format_conversations(turns.unionByName(extra)))


OP8_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, ''
      ORDER BY turn, role, text) AS roles,
    sum(10 + 9 + 4 + length(role) + length(text)
      + len(regexp_extract_all(role, '[<\[]\\*(/?s>|/?INST\])'))
      + len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\])'))) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars,
  regexp_full_match(roles, 's?u(au)*a?') AS valid
FROM joined
"""


def op9_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "p_good",
    )


def op11_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), docs AS (
  SELECT *, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0
), totals AS (
  SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM docs
), postings AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, totals GROUP BY term, nd
), asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL) GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // l))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term), totals GROUP BY item_id, doc_id, r
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op12_quadtree_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), tokens AS (
  SELECT r, lang, source, term, count(*)::HUGEINT AS c FROM (SELECT r, lang, source, unnest(terms) AS term FROM rows) GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(c)::HUGEINT AS c FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), sizes AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM rows
), cells AS (
  SELECT t.lang, t.source, t.term, sum(t.c)::HUGEINT AS c FROM tokens t SEMI JOIN kept k ON t.lang = k.lang AND t.term = k.term
  GROUP BY t.lang, t.source, t.term
), totals AS (
  SELECT g.lang, g.source, coalesce(any_value(s.v), 0)::HUGEINT AS v, coalesce(any_value(s.n), 0)::HUGEINT AS lang_n,
    coalesce(sum(x.c), 0)::HUGEINT AS n
  FROM groups g LEFT JOIN sizes s ON g.lang = s.lang LEFT JOIN cells x ON g.lang = x.lang AND g.source = x.source
  GROUP BY g.lang, g.source
), matrix AS (
  SELECT t.lang, t.source, k.term, coalesce(x.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(x.c, 0) + 1)) // (t.n + t.v) AS p,
    1 + (1000000000::HUGEINT * (k.c + 1)) // (t.lang_n + t.v) AS whole
  FROM totals t JOIN kept k ON t.lang = k.lang LEFT JOIN cells x ON x.lang = t.lang AND x.source = t.source AND x.term = k.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(any_value(f.value), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
    FROM matrix x JOIN matrix y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source
  ) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  GROUP BY a.lang, a.source, b.source
), both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value FROM pair
  UNION ALL SELECT lang, source, 'term', term, (((p - whole) * (p - whole)) // whole)::BIGINT FROM matrix WHERE c > 0 AND p > whole
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM both_parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op13_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(line_dedup.deduplicate_lines(read(spark, sf_dir, "documents")))


OP13_SQL = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM rows
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), spread AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, s.keeper IS NOT NULL AND k.doc_id < s.keeper AS dropped FROM keyed k LEFT JOIN spread s ON k.key = s.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE dropped))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""


QUERIES = {
    "op1_license_scan": (op1_license_scan, None),
    "op2_byte_bpe": (op2_byte_bpe, None),
    "op3_chosen_path": (op3_chosen_path, None),
    "op4_string_tiling": (op4_string_tiling, None),
    "op5_suffix_trees": (op5_suffix_trees, None),
    "op6_fourier_quality": (op6_fourier_quality, None),
    "op7_subword_toxicity": (op7_subword_toxicity, None),
    "op8_chat_format": (op8_chat_format, OP8_SQL),
    "op9_warc_dictionary": (op9_warc_dictionary, None),
    "pipeline": (pipeline, corpus_pipeline.ORACLE_SQL),
    "op10_quality_rules": (op10_quality_rules, None),
    "op11_block_max_search": (op11_block_max_search, OP11_SQL),
    "op12_quadtree_divergence": (op12_quadtree_divergence, OP12_SQL),
    "op13_line_bitmaps": (op13_line_bitmaps, OP13_SQL),
}
