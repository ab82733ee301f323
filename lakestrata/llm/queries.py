"""Queries of the operators, as ``(spark, sf_dir) -> DataFrame``, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import alignment, ann_mih, chat_format, filter_audit, hnsw_dedup, html_extract, language_id, lattice_lm, minhash_dedup, mixing, packing, token_counts, toxicity
from lakestrata.llm.common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.withColumn("mean_rate", F.round("mean_rate", 6))


def op2_ann_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann_mih.search(rows, rows.filter("vec_id % 20 = 0"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.learn(pages))


def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_documents(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_hnsw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, per_cent=85)


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    fixed = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    turns = chat_format.as_parts(rows.unionByName(fixed))
    return chat_format.read_back(chat_format.format_turns(turns))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_ann_mih": op2_ann_mih,
    "op3_html_extract": op3_html_extract,
    "op4_lattice_lm": op4_lattice_lm,
    "op5_toxicity": op5_toxicity,
    "op6_hnsw_dedup": op6_hnsw_dedup,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_pack": op8_pack,
    "op9_language_id": op9_language_id,
    "op10_chat_format": op10_chat_format,
    "op11_filter_audit": op11_filter_audit,
    "op12_align_tokens": op12_align_tokens,
    "op13_token_counts": op13_token_counts,
}

#: op1 by window sums over (source, k) rows in place of arrays.
OP1_SQL = """
WITH sizes AS (
  SELECT source, sum(coalesce(length(text), 0) + 1)::DOUBLE AS size FROM documents GROUP BY source
), rates AS (
  SELECT source, sum(size) OVER () * sqrt(size) / sum(sqrt(size)) OVER () / size AS mean_rate FROM sizes
), steps AS (
  SELECT source, mean_rate, k, exp(-mean_rate + k * ln(mean_rate) - sum(CASE WHEN k = 0 THEN 0 ELSE ln(k::DOUBLE) END) OVER (PARTITION BY source ORDER BY k)) AS p
  FROM (SELECT source, mean_rate, unnest(range(0, (ceil(mean_rate + 12 * sqrt(mean_rate)) + 41)::BIGINT)) AS k FROM rates)
), cdf AS (
  SELECT source, mean_rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS below FROM steps
), drawn AS (
  SELECT *, '17:' || coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(source, '-') AS key, row_number() OVER () AS row_no FROM documents
), counted AS (
  SELECT d.row_no, any_value(c.mean_rate) AS mean_rate, count(*) FILTER (WHERE c.below <= ('0x' || substr(md5(d.key), 1, 13))::BIGINT / 4503599627370496.0) AS n
  FROM drawn d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source GROUP BY d.row_no
)
SELECT doc_id, text, lang, source, n_chars, round(mean_rate, 6) AS mean_rate, copy_no::INTEGER AS copy_no, md5(key || ':' || copy_no) AS shuffle_key
FROM (SELECT d.*, c.mean_rate, unnest(range(1, c.n + 1)) AS copy_no FROM drawn d JOIN counted c USING (row_no))
"""

#: op11 document by document, without a matrix: flags, then every order on every set of failed filters.
OP11_SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), twins AS (
  SELECT text, min(doc_id) AS least FROM texts GROUP BY text
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), flagged AS (
  SELECT part, coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 3 * length(t.text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN t.doc_id > least THEN 'E' ELSE '' END AS fails
  FROM texts t JOIN twins w ON t.text = w.text LEFT JOIN marks m ON t.doc_id = m.doc_id
), sets AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flagged GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders
), cells AS (
  SELECT *, contains(fails, filter_order[step]) AS hit, translate(fails, filter_order[1:step - 1], '') <> fails AS gone FROM sets, steps
), counted AS (
  SELECT part, filter_order, step, filter_order[step] AS letter,
    coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE hit AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE fails = filter_order[step]), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE hit AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (WHERE hit AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM cells GROUP BY part, filter_order, step
)
SELECT * EXCLUDE letter, sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley FROM counted
"""

ORACLE_SQL: dict[str, str] = {"op1_mix_sources": OP1_SQL, "op11_filter_audit": OP11_SQL}
