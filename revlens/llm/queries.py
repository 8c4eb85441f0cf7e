"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_tree, decontam, hard_negatives, language, license, neardup, packing, pii, prefix_bpe, quality, rans, rules, warc
from .common import table

Builder = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.license_scan(documents(spark, sf_dir))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.token_file_round_trip(documents(spark, sf_dir), "word_bpe_49k.json")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op6_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("site_path", F.concat_ws("/", "source", "lang"))
    return quality.judge(docs, table(spark, sf_dir, "labels"), host_col="source", path_col="site_path")


def op7_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans", "n_disguised")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_best_fit(documents(spark, sf_dir), "byte_bpe_50k.json")


def op9_language_hypervectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    profiles = language.train(docs.filter(~language.held_out()))
    return (language.identify(docs, profiles).withColumn("held_out", language.held_out())
            .select("doc_id", "held_out", "lang_pred", "score"))


def op10_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = rules.apply_policy(rules.ledger(documents(spark, sf_dir)))
    base = rules.POLICIES["base-1"].mask
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (F.col("fail_mask").bitwiseAND(F.lit(base).cast("long")) != 0).alias("base_failed"), "kept",
                      "fail_mask", "policy")


def op11_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


#: Every document with every item that shares a term.
OP11_SQL = """
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents),
counted AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
rarity AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
           FROM counted, corpus GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN rarity USING (term) JOIN lengths USING (doc_id), corpus
  GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""


def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.round_trip(documents(spark, sf_dir), "byte_bpe_50k.tiktoken")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.relabelled(hard_negatives.quantised(table(spark, sf_dir, "embeddings")), every=7, n_labels=10)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


#: Every anchor with every row; fit for small tables.
OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchored AS (SELECT vec_id AS anchor_id, label AS anchor_label, q AS a FROM v WHERE vec_id % 100 = 0),
scored AS (
  SELECT anchor_id, vec_id, label = anchor_label AS same,
         coalesce(list_sum(list_transform(range(1, least(len(a), len(q)) + 1), lambda i: a[i] * q[i])), 0)::BIGINT AS score
  FROM anchored, v WHERE vec_id <> anchor_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def queries() -> dict[str, Builder]:
    return {f.__name__: f for f in (
        op1_license_templates, op2_warc_revisits, op3_rans_tokens, op4_ngram_jaccard_join, op5_decontamination,
        op6_quality_bayes, op7_pii_deobfuscation, op8_best_fit_packing, op9_language_hypervectors, op10_rule_ledger, op11_ball_tree_search,
        op12_prefix_bpe, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op11_ball_tree_search": OP11_SQL, "op13_hard_negatives": OP13_SQL}
