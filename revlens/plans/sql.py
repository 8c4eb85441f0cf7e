"""Oracle SQL building blocks (DuckDB dialect, same semantics as the Spark views)."""

REVIEWS = """reviews AS (
  SELECT o.o_custkey AS reviewer_id, l.l_partkey AS asin,
         TRY_CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS overall,
         o.o_orderstatus = 'F' AS verified,
         CAST(trunc(l.l_quantity) AS INTEGER) - 1 AS votes,
         least(l.l_linenumber, CAST(trunc(l.l_quantity) AS INTEGER) - 1) AS helpful,
         CAST(o.o_orderdate AS DATE) AS review_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

REVIEWS_CAT = """reviews AS (
  SELECT o.o_custkey AS reviewer_id, l.l_partkey AS asin,
         TRY_CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS overall,
         o.o_orderstatus = 'F' AS verified,
         CAST(trunc(l.l_quantity) AS INTEGER) - 1 AS votes,
         least(l.l_linenumber, CAST(trunc(l.l_quantity) AS INTEGER) - 1) AS helpful,
         CAST(o.o_orderdate AS DATE) AS review_date,
         p.p_type AS main_category, p.p_brand AS sub_category,
         p.p_size AS sub_sub_category, p.p_name AS final_category, p.p_name AS title
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

RAW_REVIEWS = """raw_reviews AS (
  SELECT CASE WHEN o.o_orderstatus <> 'P' THEN CAST(o.o_custkey AS VARCHAR) END AS reviewer_id,
         CASE WHEN l.l_returnflag <> 'R' THEN CAST(l.l_partkey AS VARCHAR) END AS asin,
         nullif(o.o_orderpriority, '5-LOW') AS review_text,
         CASE WHEN l.l_linestatus <> 'O' THEN TRY_CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) END AS overall,
         nullif(l.l_returnflag, 'A') AS summary,
         CAST(o.o_orderdate AS DATE) AS review_date,
         l.l_shipdate AS review_ts,
         l.l_orderkey AS order_key,
         l.l_linenumber AS line_number
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

TEXT_REVIEWS = """text_reviews AS (
  SELECT d.*, lb.quality, lb.toxic
  FROM documents d LEFT JOIN labels lb ON d.doc_id = lb.doc_id)"""

FLOWS = """flows AS (
  SELECT cn.n_name AS source, sn.n_name AS target, l.l_extendedprice AS value,
         c.c_mktsegment AS category, r.r_name AS region
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN region r ON cn.n_regionkey = r.r_regionkey)"""

CUSTOMER_TREE = """tree AS (
  SELECT c.c_custkey, r.r_name AS region, n.n_name AS nation, c.c_mktsegment AS segment,
         c.c_acctbal AS value
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

# Sunday-start week where week 1 holds January 1st (DuckDB dayofweek: Sunday = 0).
WEEK_PART = "CAST(ceil((dayofyear({d}) + dayofweek(date_trunc('year', {d})) + 1 - 1) / 7.0) AS INTEGER)"

NUMERIC_PREFIX = r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)"

# Word tokens as RegexTokenizer(pattern='\\W', toLowercase) yields them.
TOKENS = "regexp_extract_all(lower({t}), '[A-Za-z0-9_]+', 0)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
