"""Lineage loop and flattening on tiny graphs."""

import random


from tidemark.operators import lineage as L


def test_trace_terminates_on_cycle(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string")
    roots = spark.createDataFrame([("a",)], "node string")
    got = {r["node"]: r["depth"] for r in L.trace(e, roots, "down").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}
    up = {r["node"]: r["depth"] for r in L.trace(e, roots, "up").collect()}
    assert up == {"a": 0, "c": 1, "b": 2}


def test_trace_min_depth_and_keyed(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("x", "c")], "src string, dst string")
    starts = spark.createDataFrame([("a", "a"), ("x", "x")], "root string, node string")
    got = sorted((r["root"], r["node"], r["depth"]) for r in L.trace_keyed(e, starts).collect())
    assert got == [("a", "a", 0), ("a", "b", 1), ("a", "c", 1), ("x", "c", 1), ("x", "x", 0)]


def test_flatten_nested_access_log(spark):
    log = spark.createDataFrame(
        [(1, None, [("t1", ["c1"])], [("t2", [("d1", [("t1", "c1"), ("t0", "c9")])])])],
        "query_id long, ts timestamp_ntz, reads array<struct<object:string, columns:array<string>>>, "
        "writes array<struct<object:string, columns:array<struct<column:string, "
        "sources:array<struct<object:string, column:string>>>>>>")
    rows = sorted(tuple(r)[2:] for r in L.flatten_access(log).collect())
    assert rows == [("t0", "c9", "t2", "d1"), ("t1", "c1", "t2", "d1")]


def test_sql_text_facts(spark):
    q = spark.createDataFrame(
        [(1, "INSERT INTO T1 SELECT CASE WHEN a.x > 1 THEN 'y' ELSE 'n' END FROM T2 a JOIN T3 b ON a.k = b.k "
             "WHERE a.z >= 2")], "query_id long, text string")
    got = {(r["kind"], r["fact"]) for r in L.sql_text_facts(q).collect()}
    assert got == {("join", "a.k = b.k"), ("filter", "a.z >= 2"),
                   ("case", "CASE WHEN a.x > 1 THEN 'y' ELSE 'n' END")}


def test_sql_text_facts_of_real_sql(spark):
    texts = {
        1: ("select * from db.t1 a left join db.t2 as b on a.i=b.i", {("join", "a.i=b.i")}),
        2: ("SELECT a.x\nFROM t1 a\n JOIN `s`.`t2` b\n ON a.i = b.i\n JOIN t3 c ON b.k=c.k\nWHERE a.x > 1\nGROUP BY a.x ORDER BY 1",
            {("join", "a.i = b.i"), ("join", "b.k=c.k"), ("filter", "a.x > 1")}),
        3: ("delete from t where x = 'y';", {("filter", "x = 'y'")}),
        4: ("SELECT 1", set())}
    q = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "query_id long, text string")
    got = {k: set() for k in texts}
    for r in L.sql_text_facts(q).collect():
        got[r["query_id"]].add((r["kind"], r["fact"]))
    assert got == {k: want for k, (_, want) in texts.items()}


def test_write_without_source_is_no_edge(spark):
    flat = spark.createDataFrame([(1, None, None, "c", "T1", "c"), (2, None, "T1", "c", "T2", "c")],
                                 "query_id long, ts timestamp_ntz, src string, src_col string, dst string, dst_col string")
    e = L.object_edges(flat)
    assert sorted((r["node"], r["depth"]) for r in L.trace(e, L.source_nodes(e)).collect()) == [("T1", 0), ("T2", 1)]


def test_long_chain(spark):
    e = spark.range(60).selectExpr("cast(id as string) as src", "cast(id + 1 as string) as dst")
    roots = spark.createDataFrame([("0",)], "node string")
    got = {int(r["node"]): r["depth"] for r in L.trace(e, roots).collect()}
    assert got == {i: i for i in range(61)}


def test_edge_without_snippet_stays(spark):
    flat = spark.createDataFrame([(1, "a", "b"), (2, "a", "c")], "query_id long, src string, dst string")
    facts = spark.createDataFrame([(1, "join", "x = y")], "query_id long, kind string, fact string")
    assert sorted(map(tuple, L.edge_logic(flat, facts).collect()), key=str) == [("a", "b", "join", "x = y", 1), ("a", "c", None, None, 1)]


def test_paths_through_column(spark):
    ce = spark.createDataFrame([("A", "c1", "B", "c1"), ("B", "c1", "C", "c2"), ("X", "c1", "B", "c2")],
                               "src string, src_col string, dst string, dst_col string")
    got = sorted(tuple(r) for r in L.paths_through(ce, "B", "c1").collect())
    assert got == [("A", "c1", "B", "c1"), ("B", "c1", "C", "c2")]


def _reach(edges, starts):
    """Brute force: fewest hops from any of the starts."""
    depth, frontier, hop = dict.fromkeys(starts, 0), set(starts), 0
    while frontier:
        hop += 1
        frontier = {b for a, b in edges if a in frontier} - depth.keys()
        depth |= dict.fromkeys(frontier, hop)
    return depth


def _root_nodes(edges):
    """Brute force: nodes of the strongly connected components that no edge enters."""
    nodes = {x for e in edges for x in e}
    down = {n: set(_reach(edges, [n])) for n in nodes}
    same = {n: {m for m in down[n] if n in down[m]} for n in nodes}
    return {n for n in nodes if not any(b in same[n] and a not in same[n] for a, b in edges)}


def test_every_node_of_a_graph_with_cycles_is_reached(spark):
    rng = random.Random(5)
    graphs = [[(0, 1), (1, 2), (2, 0), (2, 3), (4, 3), (5, 6), (6, 5), (6, 4), (7, 7), (7, 8), (9, 9)]]
    graphs += [[(rng.randrange(30), rng.randrange(30)) for _ in range(n)] for n in (18, 34)]
    for g in graphs:
        e = spark.createDataFrame([(f"n{a:02}", f"n{b:02}") for a, b in g], "src string, dst string")
        for direction, edges in (("down", g), ("up", [(b, a) for a, b in g])):
            got = {int(r["node"][1:]): r["depth"] for r in L.trace_all(e, direction).collect()}
            assert got == _reach(edges, _root_nodes(edges)) and got.keys() == {x for pair in g for x in pair}


def test_rounds_of_several_hops_equal_single_hops(spark, monkeypatch):
    rng = random.Random(8)
    g = [(rng.randrange(40), rng.randrange(40)) for _ in range(70)]
    e = spark.createDataFrame([(str(a), str(b)) for a, b in g], "src string, dst string")
    starts = spark.createDataFrame([("3", "3"), ("7", "7")], "root string, node string")
    want = {(r, n, d) for r in (3, 7) for n, d in _reach(g, [r]).items()}
    for hops in (1, 3, 4):
        monkeypatch.setattr(L, "HOPS", hops)
        assert {(int(r["root"]), int(r["node"]), r["depth"]) for r in L.trace_keyed(e, starts).collect()} == want
        limited = {(int(r["root"]), int(r["node"]), r["depth"]) for r in L.trace_keyed(e, starts, max_depth=2).collect()}
        assert limited == {x for x in want if x[2] <= 2}


CALLS = "query_id long, parent_query_id long, role string"


def test_five_levels_of_calls(spark):
    #  1 -> 2 -> 3 -> 4 -> 5 -> 6, 2 -> 7; 8 alone; 10 <-> 11 in a circle with 12 below
    parent = {1: None, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5, 7: 2, 8: None, 10: 11, 11: 10, 12: 10}
    calls = spark.createDataFrame([(q, p, f"r{q % 2}") for q, p in parent.items()], CALLS)
    closure = L.call_closure(calls)
    want = set()
    for q in (1, 2, 3, 4, 5, 6, 7, 8):
        up, level = parent[q], 1
        while up is not None:
            want.add((up, q, level))
            up, level = parent[up], level + 1
    assert {tuple(r) for r in closure.select("procedure", "query_id", "level").collect()} == want
    log = spark.createDataFrame([(6, [("deep",)], [("out",)]), (7, [("side",), ("deep",)], []), (1, [("top",)], None), (8, [("x",)], [])],
                                "query_id long, reads array<struct<object:string>>, writes array<struct<object:string>>")
    objects = L.proc_objects(closure, L.touched_objects(log))
    got = {(r["access"], r["object"]): (r["queries"], r["nearest_level"]) for r in objects.where("procedure = 1").collect()}
    assert got == {("read", "top"): (1, 0), ("read", "side"): (1, 2), ("read", "deep"): (2, 2), ("write", "out"): (1, 5)}
    profile = {r["parent_query_id"]: tuple(r)[1:] for r in L.proc_profile(calls, closure, objects).collect()}
    assert profile[1] == (1, "r0", 2, 6, 5, 3, 1) and profile[2] == (2, "r1", 7, 5, 4, 2, 1) and profile[5] == (1, "r0", 6, 1, 1, 1, 1)
    assert profile.keys() == {1, 2, 3, 4, 5}


def test_calls_without_parents_and_long_chains(spark):
    assert L.call_closure(spark.createDataFrame([(1, None, "r")], CALLS)).count() == 0
    assert L.call_closure(spark.createDataFrame([], CALLS)).count() == 0
    chain = spark.createDataFrame([(i, i - 1 if i else None, "r") for i in range(70)], CALLS)
    got = L.call_closure(chain).collect()
    assert len(got) == 70 * 69 // 2 and all(r["query_id"] - r["procedure"] == r["level"] for r in got)


def test_reach_sketches_estimate_the_exact_trace(spark):
    rng = random.Random(11)
    n = 220
    g = {(rng.randrange(n), rng.randrange(n)) for _ in range(2 * n)} | {(i, i + 1) for i in range(0, 40)} | {(40, 0)}
    e = spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in g], "src string, dst string")
    want = {f"n{a}": len(_reach([x for x in g if x[0] != x[1]], [a])) - 1 for a in {x for p in g for x in p}}
    small = {r["node"]: (r["reach"], r["exact"]) for r in L.reach_sizes(L.reach_sketches(e, 32), 32).collect()}
    assert small.keys() == want.keys()
    assert all(small[k][0] == want[k] for k in want if want[k] + 1 < 32) and all(small[k][1] == (want[k] + 1 < 32) for k in want)
    errors = [abs(small[k][0] - want[k]) / want[k] for k in want if not small[k][1]]
    assert errors and sum(errors) / len(errors) < 2 / 32 ** 0.5
    whole = {r["node"]: r["reach"] for r in L.reach_sizes(L.reach_sketches(e, 1000), 1000).collect()}
    assert whole == want
    health = spark.createDataFrame([("n0", 1), ("lonely", 2), ("n5", 0)], "object string, failing_tests long")
    assert {tuple(r) for r in L.impact_sizes(e, health, 1000).collect()} == {("n0", want["n0"], True), ("lonely", 0, True)}


def test_column_paths_with_dots_in_names(spark):
    ce = spark.createDataFrame([("db.T", "c", "X", "x"), ("db", "T.c", "Y", "y")], "src string, src_col string, dst string, dst_col string")
    assert [tuple(r) for r in L.paths_through(ce, "db.T", "c").collect()] == [("db.T", "c", "X", "x")]


def test_catalog_of_the_session(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS tidemark_test")
    try:
        spark.sql(f"CREATE TABLE tidemark_test.a (k INT, `odd name` STRING) USING parquet LOCATION '{tmp_path}/a'")
        spark.sql(f"CREATE TABLE tidemark_test.b (x DOUBLE) USING parquet LOCATION '{tmp_path}/b'")
        spark.sql("CREATE VIEW tidemark_test.v AS SELECT k FROM tidemark_test.a")
        meta, cols = L.session_catalog(spark, ["tidemark_test"])
        got = {r["object"]: r for r in L.catalog_objects(meta, cols).collect()}
        assert {k: (r["kind"], r["n_columns"], r["columns"]) for k, r in got.items()} == {
            "tidemark_test.a": ("table", 2, "k,odd name"), "tidemark_test.b": ("table", 1, "x"), "tidemark_test.v": ("view", 1, "k")}
        assert got["tidemark_test.a"]["owner"]
        assert ("tidemark_test.b", "x", "double") in {tuple(r) for r in cols.collect()}
        assert "tidemark_test.a" in {r["object"] for r in L.session_catalog(spark)[0].collect()}
    finally:
        spark.sql("DROP DATABASE tidemark_test CASCADE")
