"""Golden values of the flat demo inputs and graph / hierarchy invariants."""

from pyspark.sql import functions as F

from revlens.operators import brush, graph


def _d(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_category_sum_golden(demo):
    assert _d(graph.category_sum(demo, "category", "value"), "category", "value") == {"A": 780, "B": 870, "C": 810}
    assert _d(graph.category_sum(demo, "region", "value"), "category", "value") == {
        "North": 370, "South": 570, "East": 670, "West": 850}


def test_category_sum_order_and_max(demo):
    out = graph.category_sum(demo, "region", "value")
    assert [r.category for r in out.collect()] == ["West", "East", "South", "North"]
    assert graph.max_domain(out).first().max_value == 850


def test_flow_matrix_golden(demo):
    cells = {(r.source, r.target): r.value for r in graph.flow_matrix(demo, "source", "target", "value").collect()}
    assert cells == {("North", "B"): 370, ("North", "A"): 220, ("North", "C"): 150, ("South", "A"): 400,
                     ("South", "B"): 200, ("South", "C"): 300, ("East", "C"): 180, ("East", "A"): 190,
                     ("West", "B"): 210, ("West", "C"): 240}


def test_flow_totals_equal_row_sums(demo):
    cells = graph.flow_matrix(demo, "source", "target", "value")
    totals = _d(graph.flow_totals(demo, "source", "target", "value"), "entity", "total")
    rows = {}
    for r in cells.collect():
        rows[r.source] = rows.get(r.source, 0) + r.value
    assert {k: v for k, v in totals.items() if v} == rows
    # target-only entities appear with 0
    assert totals["A"] == 0 and totals["B"] == 0 and totals["C"] == 0
    assert sum(totals.values()) == 2460


def test_flow_drops_null_and_non_positive(spark):
    df = spark.createDataFrame([("a", "b", 5.0), ("a", "b", None), ("a", "c", 0.0), ("a", "a", 2.0)],
                               "s string, t string, v double")
    cells = {(r.source, r.target): r.value for r in graph.flow_matrix(df, "s", "t", "v").collect()}
    assert cells == {("a", "b"): 5.0, ("a", "a"): 2.0}


def test_union_entities_sorted(demo):
    assert [r.entity for r in graph.union_entities(demo, "source", "target").collect()] == [
        "A", "B", "C", "East", "North", "South", "West"]


def test_hierarchy_rollup_total_equals_plain_total(demo):
    nodes = graph.hierarchy_rollup(demo, ["region", "category"], "value")
    root = nodes.filter("depth = 0").first().value
    assert root == 2460
    lvl1 = _d(nodes.filter("depth = 1"), "level_1", "value")
    assert lvl1 == {"North": 370, "South": 570, "East": 670, "West": 850}
    assert nodes.filter("depth = 2").count() == 12


def test_hierarchy_ragged_paths(spark):
    df = spark.createDataFrame([("x", None, "leaf1", "1"), ("x", "m", "leaf2", "2"), ("x", "m", None, "4"),
                                (None, None, None, "8"), ("", "y", "z", "16")],
                               "a string, b string, c string, v string")
    nodes = graph.hierarchy_rollup(df, ["a", "b", "c"], "v")
    got = {(r.depth, r.level_1, r.level_2, r.level_3): r.value for r in nodes.collect()}
    assert got[(0, None, None, None)] == 31.0
    # a missing middle level: leaf1 attaches directly under x
    assert got[(2, "x", "leaf1", None)] == 1.0
    assert got[(1, "x", None, None)] == 7.0
    # a missing last level keeps its value at the deepest present node
    assert got[(2, "x", "m", None)] == 6.0
    assert got[(3, "x", "m", "leaf2")] == 2.0
    # empty first level skipped: y / z move up
    assert got[(2, "y", "z", None)] == 16.0
    assert not any(k[0] == 3 and k[3] is None for k in got)


def test_path_labels_and_leaves(demo):
    nodes = graph.hierarchy_rollup(demo, ["region", "category"], "value")
    lab = graph.path_labels(nodes, ["level_1", "level_2"]).filter("depth = 2 and level_1 = 'East' and level_2 = 'B'")
    r = lab.first()
    assert r.label == "East > B" and r.node_id == "root--East--B"
    leaves = {r.leaf for r in graph.leaf_members(demo, ["region", "category"], ["East"]).collect()}
    assert leaves == {"A", "B", "C"}


def test_path_id_keeps_the_whole_path(spark):
    df = spark.createDataFrame([tuple(str(i) for i in range(12))], ",".join(f"l{i} string" for i in range(12)))
    out = graph.path_labels(df, [f"l{i}" for i in range(12)]).first()
    assert out.node_id.split("--") == ["root"] + [str(i) for i in range(12)]


def test_edge_list_rules(demo_links, spark):
    e = graph.edge_list(demo_links, "nodeId", "target", "linkValue")
    assert sorted((r.source, r.target, r.value) for r in e.collect()) == [
        ("A", "B", 5.0), ("B", "C", 15.0), ("C", "A", 25.0)]
    df = spark.createDataFrame([("a", "a", 3), ("a", None, 3), ("", "b", 3), ("a", "b", 0), ("a", "c", None)],
                               "x string, y string, v long")
    got = sorted((r.source, r.target, r.value) for r in graph.edge_list(df, "x", "y", "v").collect())
    assert got == [("a", "b", 1.0), ("a", "c", 1.0)]


def test_nodes_neighbors_incident(demo_links):
    nodes = {r.id for r in graph.union_nodes(demo_links, "nodeId", "target").collect()}
    assert nodes == {"A", "B", "C"}
    e = graph.edge_list(demo_links, "nodeId", "target", "linkValue")
    assert {r.id for r in graph.neighbors(e, "A").collect()} == {"B", "C"}
    assert graph.incident_links(e, ["B"]).count() == 2


def test_brushing(demo):
    rows = brush.brush_rows(demo, "category", ["A"])
    assert rows.count() == 4
    sel = demo.filter(F.col("value") > 275).select("category")
    assert brush.brush_rows(demo, "category", sel).count() == 8
    hl = brush.brush_highlight(demo, "category", ["A"],
                               {"radial": ["category"], "chord": ["source", "target"], "sunburst": ["region"]},
                               source_chart="radial")
    got = {(r.chart, r.value) for r in hl.collect()}
    assert ("chord", "B") in got and ("sunburst", "West") in got and not any(c == "radial" for c, _ in got)
    assert brush.brush_multi_key(demo, ["source", "target"], ["East"]).count() == 2
    assert brush.brush_multi_key(demo, ["region", "category"], [("East", "B")], mode="path").count() == 1
