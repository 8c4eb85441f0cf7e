"""Input tables and the review-shaped views derived from them.

The testdata has no review table, so the roles are derived (see FIXTURES.md
§5).  Every view is a lazy DataFrame over the whole parquet tables: column
pruning and filters of the queries that use it reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hints import spread_small
from . import derived

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BASE_REVIEW_COLUMNS = ["reviewer_id", "asin", "overall", "verified", "votes", "helpful", "review_date"]
CATEGORY_COLUMNS = ["main_category", "sub_category", "sub_sub_category", "final_category", "title"]

# Raw columns the lineitem-based views are computed from.
_LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_returnflag", "l_linestatus", "l_shipdate"]
_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
_PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]


def _review_cols(categories: bool) -> list[Column]:
    votes = F.col("l_quantity").cast("int") - F.lit(1)
    cols = [
        F.col("o_custkey").alias("reviewer_id"),
        F.col("l_partkey").alias("asin"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("overall"),
        (F.col("o_orderstatus") == F.lit("F")).alias("verified"),
        votes.alias("votes"),
        F.least(F.col("l_linenumber"), votes).alias("helpful"),
        F.col("o_orderdate").cast("date").alias("review_date"),
    ]
    if categories:
        cols += [
            F.col("p_type").alias("main_category"),
            F.col("p_brand").alias("sub_category"),
            F.col("p_size").alias("sub_sub_category"),
            F.col("p_name").alias("final_category"),
            F.col("p_name").alias("title"),
        ]
    return cols


def _raw_review_cols() -> list[Column]:
    return [
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("reviewer_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey").cast("string")).alias("asin"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("review_text"),
        F.when(F.col("l_linestatus") != "O",
               F.substring("o_orderpriority", 1, 1).try_cast("int")).alias("overall"),
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("summary"),
        F.col("o_orderdate").cast("date").alias("review_date"),
        F.col("l_shipdate").alias("review_ts"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
    ]


def _flow_cols() -> list[Column]:
    return [F.col("cn_name").alias("source"), F.col("sn_name").alias("target"),
            F.col("l_extendedprice").alias("value"), F.col("c_mktsegment").alias("category"),
            F.col("r_name").alias("region")]


def _flow_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return {
        "customer": table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
        "supplier": table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
        "cn": na.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"),
                        F.col("n_regionkey").alias("cn_region")),
        "sn": na.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name")),
        "region": table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
    }


def _line_orders(spark: SparkSession, sf_dir: str, shuffle_join: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*_LINEITEM)
    od = table(spark, sf_dir, "orders").select(*_ORDERS)
    if shuffle_join:
        od = od.hint("merge")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders, the rows of every lineitem-based view, written once per application (the one big
    join done once, lineage cut).  Dimensions are attached by the views that ask for them.

    The join is asked to be a sort-merge join: at scale it is one anyway (orders is far too big to
    broadcast), and on small inputs it spreads the build and the files it writes over all shuffle
    partitions instead of the scan's few tasks.
    """
    return derived.stored(spark, "facts", [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders")],
                          lambda: _line_orders(spark, sf_dir, shuffle_join=True).drop("o_orderkey"))


def _core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir) if derived.enabled(spark) else _line_orders(spark, sf_dir)


def reviews(spark: SparkSession, sf_dir: str, categories: bool = False) -> DataFrame:
    """Review rows: lineitem ⋈ orders (⋈ part when category levels are asked for).

    reviewer_id = o_custkey, asin = l_partkey, overall = first digit of the order
    priority (1-5), verified = status 'F', votes = quantity-1, helpful =
    least(linenumber, votes), review_date = order date.

    With materialisation on (the default) lineitem ⋈ orders is read from the stored fact table.
    """
    j = _core(spark, sf_dir)
    if categories:
        part = table(spark, sf_dir, "part").select(*_PART)
        j = j.join(part, j.l_partkey == part.p_partkey)
    return j.select(*_review_cols(categories))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review_v1-shaped rows with nulls injected, for the null-handling operators.

    The testdata has no nulls; each review field is nulled under a fixed rule
    on another column so that the same rule can be written in SQL.
    """
    return _core(spark, sf_dir).select(*_raw_review_cols())


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as review text, scored by the quality label where one exists
    (labels has one row per document, so the rows are the documents' rows).

    Queries that use no rating read ``documents`` itself, so texts are shuffled only where a rating is
    asked for and the labels are too big to broadcast.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return spread_small(table(spark, sf_dir, "documents")).join(labels, "doc_id", "left")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade flows: customer nation -> supplier nation, valued by extended price.

    ``category`` (market segment) and ``region`` (customer region) give the
    extra dimensions the brushing operators need.
    """
    dims = _flow_dimensions(spark, sf_dir)
    j = (_core(spark, sf_dir)
         .join(dims["customer"], F.col("o_custkey") == dims["customer"].c_custkey)
         .join(dims["supplier"], F.col("l_suppkey") == dims["supplier"].s_suppkey)
         .join(dims["cn"], F.col("c_nationkey") == dims["cn"].cn_key)
         .join(dims["sn"], F.col("s_nationkey") == dims["sn"].sn_key)
         .join(dims["region"], F.col("cn_region") == dims["region"].r_regionkey))
    return j.select(*_flow_cols())


def customer_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hierarchy rows: region / nation / market segment, valued by account balance."""
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    rg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = cu.join(na, cu.c_nationkey == na.n_nationkey).join(rg, F.col("n_regionkey") == rg.r_regionkey)
    return j.select("c_custkey", F.col("r_name").alias("region"), F.col("n_name").alias("nation"),
                    F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("value"))
