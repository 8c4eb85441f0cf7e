"""Queries: file round trips (each writes under a fresh folder of the checkpoint root)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_epoch_seconds
from ..functions.scalar import split_category
from ..operators.aggregate import sentiment_counts
from ..operators.charts import export_charts
from ..operators.hints import cache, repartition_by
from ..session import scratch_path
from ..sources import files as io
from ..sources.tables import customer_tree, reviews, table
from .catalog import register
from .sql import CUSTOMER_TREE, REVIEWS, REVIEWS_CAT, with_


def _events_json(spark, sf) -> tuple[str, T.StructType]:
    ev = table(spark, sf, "events")
    path = scratch_path(spark, "events-json")
    io.write_json_lines(ev, path)
    return path, ev.schema


@register("scan_json", "SELECT * FROM events")
def q_scan_json(spark, sf):
    path, schema = _events_json(spark, sf)
    return io.scan_json(spark, path, schema, keep_corrupt=False)


@register("load_counted", "SELECT count(*) AS n_records FROM events")
def q_load_counted(spark, sf):
    path, schema = _events_json(spark, sf)
    return io.count_frame(io.scan_json(spark, path, schema))


@register("scan_parquet", """
SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_discount > 0.05""")
def q_scan_parquet(spark, sf):
    return io.scan_parquet(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_extendedprice"],
                           (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
                           & (F.col("l_discount") > 0.05))


@register("write_parquet", "SELECT * FROM orders")
def q_write_parquet(spark, sf):
    path = scratch_path(spark, "orders-parquet")
    io.write_parquet(table(spark, sf, "orders"), path)
    return spark.read.parquet(path)


@register("write_partitioned", with_(REVIEWS) + "SELECT * FROM reviews")
def q_write_partitioned(spark, sf):
    path = scratch_path(spark, "reviews-by-rating")
    io.write_partitioned(reviews(spark, sf), path, "overall")
    return spark.read.parquet(path)


@register("table_bytes")
def q_table_bytes(spark, sf):
    return io.table_bytes(spark, f"{sf}/lineitem.parquet")


@register("scan_json_array", """
SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_scan_json_array(spark, sf):
    na = table(spark, sf, "nation")
    rg = table(spark, sf, "region")
    rows = na.join(rg, na.n_regionkey == rg.r_regionkey).select("n_nationkey", "n_name", "r_name")
    path = scratch_path(spark, "nations-json-array")
    io.write_json_arrays(rows, path, rows_per_file=10)
    schema = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
                           T.StructField("r_name", T.StringType())])
    return io.scan_json_array(spark, path, schema).select("n_nationkey", "n_name", "r_name")


@register("export_summary", with_(REVIEWS) + """
SELECT CASE WHEN overall >= 4 THEN 'Positive' WHEN overall = 3 THEN 'Neutral' ELSE 'Negative' END
       AS sentiment, count(*) AS count
FROM reviews GROUP BY 1""")
def q_export_summary(spark, sf):
    path = scratch_path(spark, "sentiment-csv")
    io.export_summary(sentiment_counts(reviews(spark, sf)), path, fmt="csv", single_file=True)
    return spark.read.schema("sentiment string, count bigint").option("header", True).csv(path)


@register("repartition_by", with_(REVIEWS) + "SELECT * FROM reviews")
def q_repartition_by(spark, sf):
    return repartition_by(reviews(spark, sf), 8, "overall", n_salts=64)


@register("cache", "SELECT * FROM customer")
def q_cache(spark, sf):
    return cache(table(spark, sf, "customer"))


@register("pragma_labels", """
SELECT 'label_para' AS label, CAST(count_if(l_quantity > 25) AS BIGINT) AS rows FROM lineitem
UNION ALL SELECT 'label_reduction', CAST(count_if(l_returnflag = 'R') AS BIGINT) FROM lineitem
UNION ALL SELECT 'label_simd', CAST(count_if(l_discount > 0.05) AS BIGINT) FROM lineitem""")
def q_pragma_labels(spark, sf):
    """Label rows written as JSON lines, read with the fixed schema and counted by label."""
    flags = {"label_para": F.col("l_quantity") > 25, "label_reduction": F.col("l_returnflag") == "R",
             "label_simd": F.col("l_discount") > 0.05}
    path = scratch_path(spark, "pragma-json")
    io.write_json_lines(table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("ID"), F.col("l_linenumber").cast("string").alias("realId"),
        F.col("l_linestatus").alias("pragma"), *[c.cast("int").alias(n) for n, c in flags.items()]), path)
    return io.label_counts(io.scan_json(spark, path, io.BONUS_SCHEMA, keep_corrupt=False), list(flags))


@register("review_v0_normalize", with_(REVIEWS) + """
SELECT CAST(reviewer_id AS VARCHAR) AS "reviewerID", overall, helpful AS helpful_votes, votes AS all_votes, review_date
FROM reviews""")
def q_review_v0_normalize(spark, sf):
    path = scratch_path(spark, "reviews-v0-json")
    io.write_json_lines(reviews(spark, sf).select(
        F.col("reviewer_id").cast("string").alias("reviewerID"), F.col("overall").cast("double").alias("overall"),
        F.format_string("[%d, %d]", "helpful", "votes").alias("helpful"),
        F.date_format("review_date", "MM d, yyyy").alias("reviewTime")), path)
    out = io.normalize_reviews(io.scan_json(spark, path, io.REVIEW_V0_SCHEMA, keep_corrupt=False))
    return out.select("reviewerID", "overall", "helpful_votes", "all_votes", "review_date")


# The seven exported charts as (chart, key, value); value rounded so that both engines' last digits agree.
_CHART_CELLS = {
    "top_reviewed_products": ("CAST(asin AS STRING)", "review_count"),
    "review_distribution": ("'median'", "median"),
    "sentiment_distribution": ("sentiment", "count"),
    "review_trends": ("CAST(month AS STRING)", "review_count"),
    "verified_vs_non_verified": ("CAST(verified AS STRING)", "avg_rating"),
    "review_length_vs_rating": ("concat(length_bin, '/', overall)", "count"),
    "correlation_heatmap": ("concat(x, '/', y)", "r"),
}


@register("export_charts", with_(REVIEWS_CAT).rstrip() + """,
t AS (SELECT *, length(title) AS review_length FROM reviews),
cells AS (
  SELECT 'top_reviewed_products' AS chart, CAST(asin AS VARCHAR) AS key, CAST(n AS DOUBLE) AS value
  FROM (SELECT asin, count(*) AS n FROM t GROUP BY asin ORDER BY n DESC, asin LIMIT 10)
  UNION ALL SELECT 'review_distribution', 'median', quantile_cont(overall, 0.5) FROM t
  UNION ALL SELECT 'sentiment_distribution', CASE WHEN overall >= 4 THEN 'Positive' WHEN overall = 3 THEN 'Neutral'
                                             ELSE 'Negative' END AS key, count(*) FROM t GROUP BY 2
  UNION ALL SELECT 'review_trends', CAST(CAST(date_trunc('month', review_date) AS DATE) AS VARCHAR) AS key, count(*)
  FROM t WHERE review_date IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'verified_vs_non_verified', CAST(verified AS VARCHAR) AS key, avg(overall) FROM t GROUP BY 2
  UNION ALL SELECT 'review_length_vs_rating',
                   concat(CAST(floor(review_length / 5) * 5 AS BIGINT), '/', overall) AS key, count(*) FROM t GROUP BY 2
  UNION ALL SELECT 'correlation_heatmap', 'overall/overall', corr(overall, overall) FROM t
  UNION ALL SELECT 'correlation_heatmap', 'review_length/review_length', corr(review_length, review_length) FROM t
  UNION ALL SELECT 'correlation_heatmap', 'overall/review_length', corr(overall, review_length) FROM t
  UNION ALL SELECT 'correlation_heatmap', 'review_length/overall', corr(overall, review_length) FROM t)
SELECT chart, key, round(value, 6) AS value FROM cells""")
def q_export_charts(spark, sf):
    """I10 whole: every chart written by the export and read back."""
    written = export_charts(reviews(spark, sf, categories=True), scratch_path(spark, "charts"), fmt="parquet",
                            text_col="title", length_bin=5)
    cells = [spark.read.parquet(path).select(F.lit(name).alias("chart"), F.expr(_CHART_CELLS[name][0]).alias("key"),
                                             F.round(F.expr(f"CAST({_CHART_CELLS[name][1]} AS DOUBLE)"), 6).alias("value"))
             for name, path in written.items()]
    return reduce(lambda a, b: a.unionByName(b), cells)


@register("split_category", with_(CUSTOMER_TREE) + """
SELECT c_custkey, string_split(path, '/')[1] AS level_1, string_split(path, '/')[2] AS level_2,
       string_split(path, '/')[3] AS level_3, string_split(path, '/')[-1] AS level_final
FROM (SELECT c_custkey, concat_ws('/', region, nation, segment) AS path FROM tree)""")
def q_split_category(spark, sf):
    t = customer_tree(spark, sf).select("c_custkey", F.concat_ws("/", "region", "nation", "segment").alias("path"))
    return t.select("c_custkey", *split_category("path", "/", 4))


def _review_json_lines(spark, sf):
    """Review rows written as JSON text the way the dumps look: rating 3.0,
    flag as the string "false"/"true", votes with a thousands comma, dates as
    'MM d, yyyy'; unverified one-star rows without helpful votes are written
    as malformed lines."""
    r = reviews(spark, sf)
    v = F.col("votes") * F.lit(100)
    obj = F.to_json(F.struct(
        F.col("reviewer_id").cast("string").alias("reviewerID"),
        F.col("asin").cast("string").alias("asin"),
        F.col("overall").cast("double").alias("overall"),
        F.col("verified").cast("string").alias("verified"),
        F.format_number(v, 0).alias("vote"),
        date_epoch_seconds("review_date").alias("unixReviewTime"),
        F.date_format("review_date", "MM d, yyyy").alias("reviewTime")))
    line = F.when((F.col("helpful") == 0) & (F.col("overall") == 1) & ~F.col("verified"),
                  F.concat(F.lit("{broken "), obj)).otherwise(obj)
    path = scratch_path(spark, "reviews-json")
    r.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


@register("review_json_normalize", with_(REVIEWS) + """
SELECT CASE WHEN bad THEN NULL ELSE CAST(reviewer_id AS VARCHAR) END AS reviewerID,
       CASE WHEN bad THEN NULL ELSE CAST(asin AS VARCHAR) END AS asin,
       CASE WHEN bad THEN NULL ELSE overall END AS overall,
       CASE WHEN bad THEN NULL ELSE verified END AS verified,
       CASE WHEN bad OR votes * 100 >= 1000 THEN NULL ELSE votes * 100 END AS vote,
       CASE WHEN bad THEN NULL ELSE review_date END AS review_date,
       CASE WHEN bad THEN NULL ELSE CAST(epoch(CAST(review_date AS TIMESTAMP)) AS BIGINT) END AS unixReviewTime,
       bad AS corrupt
FROM (SELECT *, helpful = 0 AND overall = 1 AND NOT verified AS bad FROM reviews)""")
def q_review_json_normalize(spark, sf):
    path = _review_json_lines(spark, sf)
    raw = io.scan_json(spark, path, io.REVIEW_RAW_SCHEMA)
    out = io.normalize_reviews(raw)
    return out.select("reviewerID", "asin", "overall", "verified", "vote", "review_date", "unixReviewTime",
                      F.col(io.CORRUPT).isNotNull().alias("corrupt"))
