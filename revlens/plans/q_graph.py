"""Queries: flows, edge lists, hierarchies, brushing and relating extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import brush, graph
from ..operators.relationship import Measure, Relationship
from ..sources.tables import customer_tree, flows, table
from .catalog import register
from .sql import CUSTOMER_TREE, FLOWS, with_

FL = with_(FLOWS)
TR = with_(CUSTOMER_TREE)


@register("category_sum", FL + """
SELECT category, round(sum(value), 2) AS value FROM flows GROUP BY category""")
def q_category_sum(spark, sf):
    return graph.category_sum(flows(spark, sf), "category", "value").withColumn("value", F.round("value", 2))


@register("max_domain", FL + """
SELECT round(max(v), 2) AS max_value FROM (SELECT category, sum(value) AS v FROM flows GROUP BY category)""")
def q_max_domain(spark, sf):
    agg = graph.category_sum(flows(spark, sf), "category", "value")
    return graph.max_domain(agg).select(F.round("max_value", 2).alias("max_value"))


@register("distinct_values", FL + """
SELECT DISTINCT region FROM flows""")
def q_distinct_values(spark, sf):
    return graph.distinct_values(flows(spark, sf), "region")


@register("flow_matrix", FL + """
SELECT source, target, round(sum(value), 2) AS value FROM flows WHERE value > 0 GROUP BY source, target""")
def q_flow_matrix(spark, sf):
    return graph.flow_matrix(flows(spark, sf), "source", "target", "value").withColumn("value", F.round("value", 2))


@register("union_entities", FL + """
SELECT source AS entity FROM flows UNION SELECT target FROM flows ORDER BY 1""")
def q_union_entities(spark, sf):
    return graph.union_entities(flows(spark, sf), "source", "target")


@register("flow_totals", FL.rstrip() + """
, e AS (SELECT source AS entity FROM flows WHERE value > 0 UNION SELECT target FROM flows WHERE value > 0),
t AS (SELECT source AS entity, sum(value) AS total FROM flows WHERE value > 0 GROUP BY source)
SELECT e.entity, round(coalesce(t.total, 0.0), 2) AS total FROM e LEFT JOIN t ON e.entity = t.entity""")
def q_flow_totals(spark, sf):
    return graph.flow_totals(flows(spark, sf), "source", "target", "value").withColumn("total", F.round("total", 2))


@register("union_nodes", FL + """
SELECT id FROM (SELECT CAST(source AS VARCHAR) AS id FROM flows UNION SELECT CAST(target AS VARCHAR) FROM flows)
WHERE id IS NOT NULL""")
def q_union_nodes(spark, sf):
    return graph.union_nodes(flows(spark, sf), "source", "target")


_EDGES_SQL = """edges AS (
  SELECT CAST(source AS VARCHAR) AS source, CAST(target AS VARCHAR) AS target,
         CASE WHEN value IS NULL OR isnan(value) OR value = 0 THEN 1.0 ELSE value END AS value
  FROM flows
  WHERE source IS NOT NULL AND source <> '' AND target IS NOT NULL AND target <> '' AND source <> target)"""


@register("edge_list", with_(FLOWS, _EDGES_SQL) + "SELECT * FROM edges")
def q_edge_list(spark, sf):
    return graph.edge_list(flows(spark, sf), "source", "target", "value")


@register("neighbors", with_(FLOWS, _EDGES_SQL) + """
SELECT target AS id FROM edges WHERE source = 'NATION_3'
UNION SELECT source FROM edges WHERE target = 'NATION_3'""")
def q_neighbors(spark, sf):
    return graph.neighbors(graph.edge_list(flows(spark, sf), "source", "target", "value"), "NATION_3")


@register("incident_links", with_(FLOWS, _EDGES_SQL) + """
SELECT * FROM edges WHERE source IN ('NATION_1', 'NATION_2') OR target IN ('NATION_1', 'NATION_2')""")
def q_incident_links(spark, sf):
    e = graph.edge_list(flows(spark, sf), "source", "target", "value")
    return graph.incident_links(e, ["NATION_1", "NATION_2"])


_LEVELS = ["region", "nation", "segment"]

_ROLLUP_SQL = """p AS (
  SELECT list_filter([CASE WHEN region <> '' THEN region END, CASE WHEN nation <> '' THEN nation END,
                      CASE WHEN segment <> '' THEN segment END], lambda x: x IS NOT NULL) AS path,
         CASE WHEN value IS NULL OR isnan(value) THEN 0.0 ELSE value END AS v
  FROM tree),
q AS (SELECT path[1] AS level_1, path[2] AS level_2, path[3] AS level_3, v FROM p),
nodes AS (
  SELECT level_1, level_2, level_3, sum(v) AS value,
         CAST(3 - grouping(level_1) - grouping(level_2) - grouping(level_3) AS INTEGER) AS depth
  FROM q GROUP BY ROLLUP (level_1, level_2, level_3))"""

_REAL_NODE = """(depth = 0 OR (depth = 1 AND level_1 IS NOT NULL) OR (depth = 2 AND level_2 IS NOT NULL)
                 OR (depth = 3 AND level_3 IS NOT NULL))"""


@register("hierarchy_rollup", with_(CUSTOMER_TREE, _ROLLUP_SQL) + f"""
SELECT level_1, level_2, level_3, round(value, 2) AS value, depth FROM nodes WHERE {_REAL_NODE}""")
def q_hierarchy_rollup(spark, sf):
    out = graph.hierarchy_rollup(customer_tree(spark, sf), _LEVELS, "value")
    return out.withColumn("value", F.round("value", 2))


@register("path_labels", with_(CUSTOMER_TREE, _ROLLUP_SQL) + f"""
SELECT level_1, level_2, level_3, round(value, 2) AS value, depth,
       array_to_string(list_filter([level_1, level_2, level_3], lambda x: x IS NOT NULL), ' > ') AS label,
       array_to_string(list_concat(['root'], list_filter([level_1, level_2, level_3], lambda x: x IS NOT NULL)), '--')
         AS node_id
FROM nodes WHERE {_REAL_NODE}""")
def q_path_labels(spark, sf):
    nodes = graph.hierarchy_rollup(customer_tree(spark, sf), _LEVELS, "value").withColumn("value", F.round("value", 2))
    return graph.path_labels(nodes, ["level_1", "level_2", "level_3"])


@register("leaf_members", TR + """
SELECT DISTINCT segment AS leaf FROM tree WHERE region = 'ASIA'""")
def q_leaf_members(spark, sf):
    return graph.leaf_members(customer_tree(spark, sf), _LEVELS, ["ASIA"])


@register("brush_rows", FL + """
SELECT * FROM flows WHERE coalesce(CAST(category AS VARCHAR), 'null') IN ('BUILDING', 'MACHINERY')""")
def q_brush_rows(spark, sf):
    return brush.brush_rows(flows(spark, sf), "category", ["BUILDING", "MACHINERY"])


@register("brush_rows_semi", FL + """
SELECT * FROM flows WHERE CAST(category AS VARCHAR) IN (
  SELECT DISTINCT CAST(c_mktsegment AS VARCHAR) FROM customer WHERE c_acctbal > 9950)""")
def q_brush_rows_semi(spark, sf):
    sel = table(spark, sf, "customer").filter(F.col("c_acctbal") > 9950).select("c_mktsegment")
    return brush.brush_rows(flows(spark, sf), "category", sel)


@register("brush_multi_key", FL + """
SELECT * FROM flows WHERE source IN ('NATION_7') OR target IN ('NATION_7')""")
def q_brush_multi_key(spark, sf):
    return brush.brush_multi_key(flows(spark, sf), ["source", "target"], ["NATION_7"], mode="any")


@register("brush_path", FL + """
SELECT * FROM flows WHERE (region = 'EUROPE' AND category = 'BUILDING') OR (region = 'ASIA' AND category = 'MACHINERY')""")
def q_brush_path(spark, sf):
    return brush.brush_multi_key(flows(spark, sf), ["region", "category"],
                                 [("EUROPE", "BUILDING"), ("ASIA", "MACHINERY")], mode="path")


@register("brush_highlight", FL.rstrip() + """
, s AS (SELECT * FROM flows WHERE category IN ('BUILDING'))
SELECT DISTINCT chart, value FROM (
  SELECT 'chord' AS chart, source AS value FROM s UNION ALL SELECT 'chord', target FROM s
  UNION ALL SELECT 'force', source FROM s UNION ALL SELECT 'force', target FROM s
  UNION ALL SELECT 'sunburst', region FROM s) WHERE value IS NOT NULL""")
def q_brush_highlight(spark, sf):
    roles = {"radial": ["category"], "chord": ["source", "target"], "force": ["source", "target"],
             "sunburst": ["region"]}
    return brush.brush_highlight(flows(spark, sf), "category", ["BUILDING"], roles, source_chart="radial")


@register("relate_inner", """
SELECT o.o_orderkey, o.o_custkey AS custkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_relate_inner(spark, sf):
    od = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"), "o_totalprice")
    cu = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return brush.relate(od, cu, "custkey", "inner")


@register("relate_left", """
SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_relate_left(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return brush.relate(docs, table(spark, sf, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
@register("relate_measures", """WITH b AS (SELECT DISTINCT user_id, event_type FROM events WHERE user_id IS NOT NULL),
c AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_custkey IS NOT NULL),
l AS (SELECT o_orderpriority, event_type, count(*) AS orders, round(sum(o_totalprice), 2) AS price, max(o_totalprice) AS dearest
      FROM orders LEFT JOIN b ON o_custkey = user_id GROUP BY ALL),
r AS (SELECT o_orderpriority, event_type, count(*) AS events, round(avg(value), 6) AS avg_value, count(DISTINCT user_id) AS users
      FROM events LEFT JOIN c ON o_custkey = user_id GROUP BY ALL)
SELECT coalesce(l.o_orderpriority, r.o_orderpriority) AS o_orderpriority, coalesce(l.event_type, r.event_type) AS event_type,
       CAST(orders AS BIGINT) AS orders, price, dearest, CAST(events AS BIGINT) AS events, avg_value, CAST(users AS BIGINT) AS users
FROM l FULL JOIN r ON l.o_orderpriority IS NOT DISTINCT FROM r.o_orderpriority AND l.event_type IS NOT DISTINCT FROM r.event_type""")
def q_relate_measures(spark, sf):
    """Many orders and many events a customer: neither table's sums are multiplied by the other's rows."""
    out = _orders_events(spark, sf).measures(
        [("left", "o_orderpriority"), ("right", "event_type")],
        {"orders": Measure("left", "rows"), "price": Measure("left", "sum", "o_totalprice"),
         "dearest": Measure("left", "max", "o_totalprice"), "events": Measure("right", "rows"),
         "avg_value": Measure("right", "avg", "value"), "users": Measure("right", "distinct", "user_id")})
    return out.withColumns({"price": F.round("price", 2), "avg_value": F.round("avg_value", 6)})


@register("relate_measures_one_side", """
SELECT o_orderpriority, count(*) AS orders, round(avg(o_totalprice), 4) AS avg_price, count(DISTINCT o_custkey) AS customers
FROM orders GROUP BY o_orderpriority""")
def q_relate_measures_one_side(spark, sf):
    """Only orders are asked for, so events are not read."""
    out = _orders_events(spark, sf).measures(
        [("left", "o_orderpriority")], {"orders": Measure("left", "rows"), "avg_price": Measure("left", "avg", "o_totalprice"),
                                        "customers": Measure("left", "distinct", "o_custkey")})
    return out.withColumn("avg_price", F.round("avg_price", 4))


@register("relate_measures_filtered", """WITH big AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_totalprice > 200000)
SELECT coalesce(l.o_orderpriority, r.o_orderpriority) AS o_orderpriority, orders, events, clicks_or_views
FROM (SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_totalprice > 200000
      AND o_custkey IN (SELECT user_id FROM events WHERE event_type IN ('click', 'view')) GROUP BY 1) l
FULL JOIN (SELECT o_orderpriority, count(*) AS events, max(value) AS clicks_or_views FROM events JOIN big ON o_custkey = user_id
           WHERE event_type IN ('click', 'view') GROUP BY 1) r ON l.o_orderpriority IS NOT DISTINCT FROM r.o_orderpriority""")
def q_relate_measures_filtered(spark, sf):
    """A filter on either table leaves the other's related rows only."""
    return _orders_events(spark, sf).measures(
        [("left", "o_orderpriority")], {"orders": Measure("left", "rows"), "events": Measure("right", "rows"),
                                        "clicks_or_views": Measure("right", "max", "value")},
        where={"left": F.col("o_totalprice") > 200000, "right": F.col("event_type").isin("click", "view")})


def _orders_events(spark, sf) -> Relationship:
    return Relationship(table(spark, sf, "orders"), table(spark, sf, "events"), [("o_custkey", "user_id")])


