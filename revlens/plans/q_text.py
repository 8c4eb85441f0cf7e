"""Queries: text mining over documents (with quality labels as the rating)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as ag
from ..operators import text as tx
from ..operators.hints import spread_small
from ..sources.tables import table, text_reviews
from .catalog import register
from .sql import TEXT_REVIEWS, TOKENS, with_

TR = with_(TEXT_REVIEWS)
TOK = TOKENS.format(t="text")


def _stop_list_sql() -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in tx.default_stop_words()) + "]"


def filtered_sql() -> str:
    return f"list_filter({TOK}, lambda x: NOT list_contains({_stop_list_sql()}, lower(x)))"


def _texts(spark, sf, *carry):
    return spread_small(table(spark, sf, "documents").select(*carry, "text"))


@register("tokenize", f"""
SELECT doc_id, CAST(len({TOK}) AS INTEGER) AS n_tokens, array_to_string({TOK}, ' ') AS tokens FROM documents""")
def q_tokenize(spark, sf):
    d = tx.tokenize(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return d.select("doc_id", F.size("words").alias("n_tokens"), F.array_join("words", " ").alias("tokens"))


@register("remove_stopwords", f"""
SELECT doc_id, CAST(len(f) AS INTEGER) AS n_tokens, array_to_string(f, ' ') AS tokens
FROM (SELECT doc_id, {filtered_sql()} AS f FROM documents)""")
def q_remove_stopwords(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", tx.without_stop_words(tx.tokens("text"), lowercase=False).alias("filtered"))
    return d.select("doc_id", F.size("filtered").alias("n_tokens"), F.array_join("filtered", " ").alias("tokens"))


@register("word_freq", f"""
SELECT word, count(*) AS count FROM (SELECT unnest({filtered_sql()}) AS word FROM documents)
GROUP BY word ORDER BY count DESC, word LIMIT 100""")
def q_word_freq(spark, sf):
    return tx.word_freq(_texts(spark, sf), "text", 100)


@register("heavy_words", f"""
SELECT word, count(*) AS count FROM (SELECT unnest({filtered_sql()}) AS word FROM documents)
GROUP BY word ORDER BY count DESC, word LIMIT 100""")
def q_heavy_words(spark, sf):
    """``word_freq`` from summaries of bounded size and a second pass over their words."""
    return tx.heavy_words(_texts(spark, sf), "text", 100)


@register("cloud_words", f"""
WITH top AS (SELECT word, count(*) AS count FROM (SELECT unnest({filtered_sql()}) AS word FROM documents)
             GROUP BY word ORDER BY count DESC, word LIMIT 100)
SELECT word, count, count / (SELECT max(count) FROM top) AS weight FROM top""")
def q_cloud_words(spark, sf):
    return tx.cloud_words(_texts(spark, sf), "text", 100)


def _folded_sql(word: str) -> tuple[str, str]:
    """Stem of a word, and the word that a group of the same stem shows."""
    stem = f"CASE WHEN {word} LIKE '%s' AND {word} NOT LIKE '%ss' AND len({word}) > 1 THEN {word}[:-2] ELSE {word} END"
    return stem, f"CASE WHEN bool_or({word} = {stem}) THEN any_value({stem}) ELSE any_value({stem}) || 's' END"


def _collocations_sql() -> str:
    stop, (stem, shown), (stem1, _) = _stop_list_sql(), _folded_sql("word"), _folded_sql("word1")
    like = "ln(greatest({x}, 1e-10)) * {k} + ln(greatest(1 - {x}, 1e-10)) * ({n} - {k})".format
    parts = (like(k="k", n="c1", x="p"), like(k="(c2 - k)", n="(total - c1)", x="p"), like(k="k", n="c1", x="p1"), like(k="(c2 - k)", n="(total - c1)", x="p2"))
    return f"""WITH docs AS (SELECT {TOK} AS t FROM documents),
all_words AS (SELECT unnest(t) AS word FROM docs),
u AS (SELECT word, count(*) AS count FROM all_words WHERE NOT list_contains({stop}, word) GROUP BY 1),
words AS (SELECT {stem} AS stem, sum(count)::BIGINT AS count, {shown} AS word FROM u GROUP BY 1),
places AS (SELECT t, unnest(range(1, len(t))) AS i FROM docs WHERE len(t) > 1),
near AS (SELECT t[i] AS word1, t[i + 1] AS word, count(*) AS count FROM places
         WHERE NOT list_contains({stop}, t[i]) AND NOT list_contains({stop}, t[i + 1]) GROUP BY ALL),
pairs AS (SELECT word1, {stem} AS stem2, sum(count)::BIGINT AS count, {shown} AS word2 FROM near GROUP BY 1, 2),
known AS (SELECT word1, word2, {stem1} AS stem1, stem2, count, count::DOUBLE AS k, (SELECT sum(count)::DOUBLE FROM words) AS total FROM pairs),
rates AS (SELECT known.*, a.count::DOUBLE AS c1, b.count::DOUBLE AS c2, b.count / total AS p, k / a.count AS p1,
                 coalesce((b.count - k) / nullif(total - a.count, 0), 0) AS p2
          FROM known JOIN words a ON a.stem = stem1 JOIN words b ON b.stem = stem2),
found AS (SELECT *, -2 * ({parts[0]} + {parts[1]} - ({parts[2]}) - ({parts[3]})) AS score FROM rates)
"""


@register("collocations", _collocations_sql() + "SELECT word1, word2, count, round(score, 2) AS score FROM found WHERE score > 30")
def q_collocations(spark, sf):
    return tx.collocations(_texts(spark, sf), "text").withColumn("score", F.round("score", 2))


@register("cloud_terms", _collocations_sql().rstrip() + """,
coll AS (SELECT * FROM found WHERE score > 30),
taken AS (SELECT stem, sum(count) AS taken FROM (SELECT stem1 AS stem, count FROM coll UNION ALL SELECT stem2, count FROM coll) GROUP BY stem),
terms AS (SELECT word AS term, CAST(count - coalesce(taken, 0) AS BIGINT) AS count FROM words LEFT JOIN taken USING (stem)
          UNION ALL SELECT word1 || ' ' || word2, count FROM coll),
top AS (SELECT term, count FROM terms WHERE count > 0 ORDER BY count DESC, term LIMIT 100)
SELECT term, count, count / (SELECT max(count) FROM top) AS weight FROM top""")
def q_cloud_terms(spark, sf):
    return tx.cloud_terms(_texts(spark, sf), "text", 100)


@register("word_repetition", """
SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS word_count,
       CAST(len(list_distinct(string_split(text, ' '))) AS INTEGER) AS unique_word_count,
       len(string_split(text, ' ')) / len(list_distinct(string_split(text, ' '))) AS word_repetition_ratio
FROM documents WHERE text IS NOT NULL ORDER BY word_repetition_ratio DESC, doc_id LIMIT 5""")
def q_word_repetition(spark, sf):
    return tx.word_repetition(_texts(spark, sf, "doc_id"), "text", "doc_id", 5)


@register("word_sentiment", TR + """
SELECT word, avg(quality) AS avg_rating, count(word) AS word_count
FROM (SELECT quality, unnest(string_split(text, ' ')) AS word FROM text_reviews)
GROUP BY word HAVING count(word) > 50""")
def q_word_sentiment(spark, sf):
    return tx.word_sentiment(text_reviews(spark, sf), "text", "quality", 50)


@register("keyword_sentiment", TR + f"""
SELECT keyword, quality, count(keyword) AS count
FROM (SELECT quality, unnest({filtered_sql()}) AS keyword FROM text_reviews)
GROUP BY keyword, quality""")
def q_keyword_sentiment(spark, sf):
    kw = tx.keywords(text_reviews(spark, sf), "text", "quality", out="keyword")
    return ag.keyword_sentiment(kw, "keyword", "quality")


@register("keyword_share", """
SELECT coalesce(avg(CASE WHEN regexp_matches(text, 'refund|return|defective', 'i') THEN 1 ELSE 0 END) * 100.0, 0.0)
       AS keyword_pct FROM documents""")
def q_keyword_share(spark, sf):
    return ag.keyword_share(_texts(spark, sf), "text")


@register("label_frequency", """
SELECT source, count(*) AS count FROM documents GROUP BY source ORDER BY count DESC, source LIMIT 5""")
def q_label_frequency(spark, sf):
    return ag.label_frequency(table(spark, sf, "documents"), "source", 5)


@register("length_rating_bins", TR + """
SELECT CAST(floor(length(text) / 1000) * 1000 AS BIGINT) AS length_bin, quality, count(*) AS count
FROM text_reviews GROUP BY 1, 2""")
def q_length_rating_bins(spark, sf):
    df = text_reviews(spark, sf).withColumn("review_length", F.length("text"))
    return ag.length_rating_bins(df, "review_length", "quality", 1000)
