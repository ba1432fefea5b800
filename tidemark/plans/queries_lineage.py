"""Registered queries of the lineage and data-quality workload (S3, S4, L1-L9, W5, J11-J13,
A19, F13, F14), each with its DuckDB oracle (recursive CTEs for the traces)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from .. import thresholds as T
from ..operators import lineage as L
from ..operators import reach_index as R
from ..sources import bindings as B
from ..session import StagedTables, reliable_checkpoint
from .registry import query

# Freshness is judged at the end of the event run date.
AS_OF = _dt.datetime.combine(T.EVENTS_RUN_DATE + _dt.timedelta(days=1), _dt.time())
# The column whose paths L5 highlights (a user's click in the lineage canvas).
PATH_OBJECT, PATH_COLUMN = "T1", "c1"


def _flat(spark, d):
    return L.flatten_access(B.access_log(spark, d))


def _edges(spark, d):
    return L.object_edges(_flat(spark, d))


def _health(spark, d):
    return L.node_health(L.latest_dq(B.dq_results(spark, d)))


@query("access_log_flatten", sql="SELECT * FROM flat")
def access_log_flatten(spark, d):
    return _flat(spark, d)


@query("catalog_scan", sql="""
SELECT m.object, m.kind, m.owner, c.n_columns, c.columns
FROM object_meta m LEFT JOIN (
  SELECT 'T' || CAST(p_partkey AS VARCHAR) AS object, CAST(3 AS BIGINT) AS n_columns, 'c1,c2,c3' AS columns FROM part) c
  ON m.object = c.object""")
def catalog_scan(spark, d):
    return L.catalog_objects(B.object_meta(spark, d), B.object_columns(spark, d))


@query("lineage_edges", sql="""
SELECT src, dst, MIN(ts) AS first_seen, MAX(ts) AS last_seen, COUNT(DISTINCT query_id) AS query_count
FROM flat GROUP BY src, dst""")
def lineage_edges(spark, d):
    return _edges(spark, d)


@query("lineage_column_edges", sql="""
SELECT src, src_col, dst, dst_col, MIN(ts) AS first_seen, MAX(ts) AS last_seen,
  COUNT(DISTINCT query_id) AS query_count
FROM flat GROUP BY src, src_col, dst, dst_col""")
def lineage_column_edges(spark, d):
    return L.column_edges(_flat(spark, d))


@query("lineage_downstream", sql="""
WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM flat),
roots AS (SELECT DISTINCT src AS node FROM e WHERE src NOT IN (SELECT dst FROM e)),
t(node, depth) AS (SELECT node, 0 FROM roots
                   UNION SELECT e.dst, t.depth + 1 FROM t JOIN e ON e.src = t.node)
SELECT node, MIN(depth) AS depth FROM t GROUP BY node""")
def lineage_downstream(spark, d):
    return L.trace_all(_edges(spark, d), "down")


@query("lineage_upstream", sql="""
WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM flat),
roots AS (SELECT DISTINCT dst AS node FROM e WHERE dst NOT IN (SELECT src FROM e)),
t(node, depth) AS (SELECT node, 0 FROM roots
                   UNION SELECT e.src, t.depth + 1 FROM t JOIN e ON e.dst = t.node)
SELECT node, MIN(depth) AS depth FROM t GROUP BY node""")
def lineage_upstream(spark, d):
    return L.trace_all(_edges(spark, d), "up")


@query("lineage_column_path", sql=f"""
WITH RECURSIVE ce AS (SELECT DISTINCT src, src_col, dst, dst_col, src || '.' || src_col AS a,
                        dst || '.' || dst_col AS b FROM flat),
up(node) AS (SELECT '{PATH_OBJECT}.{PATH_COLUMN}' UNION SELECT ce.a FROM up JOIN ce ON ce.b = up.node),
down(node) AS (SELECT '{PATH_OBJECT}.{PATH_COLUMN}' UNION SELECT ce.b FROM down JOIN ce ON ce.a = down.node)
SELECT DISTINCT src, src_col, dst, dst_col FROM ce
WHERE (a IN (SELECT node FROM up) AND b IN (SELECT node FROM up))
   OR (a IN (SELECT node FROM down) AND b IN (SELECT node FROM down))""")
def lineage_column_path(spark, d):
    return L.paths_through(reliable_checkpoint(L.column_edges(_flat(spark, d))), PATH_OBJECT, PATH_COLUMN)


@query("lineage_path_sizes", sql="""
WITH RECURSIVE ce AS (SELECT DISTINCT src || '.' || src_col AS a, src, dst || '.' || dst_col AS b, dst FROM flat),
fail AS (SELECT object FROM node_health WHERE failing_tests > 0),
clicks AS (SELECT a AS root FROM ce WHERE src IN (SELECT object FROM fail) UNION SELECT b FROM ce WHERE dst IN (SELECT object FROM fail)),
up(root, node) AS (SELECT root, root FROM clicks UNION SELECT up.root, ce.a FROM up JOIN ce ON ce.b = up.node),
down(root, node) AS (SELECT root, root FROM clicks UNION SELECT down.root, ce.b FROM down JOIN ce ON ce.a = down.node)
SELECT root, COUNT(*) AS edges FROM (SELECT root, a, b FROM down JOIN ce ON ce.a = down.node
                                     UNION SELECT root, a, b FROM up JOIN ce ON ce.b = up.node) GROUP BY root""")
def lineage_path_sizes(spark, d):
    """L5 for every column of the failing objects, from one reachability index: how many edges lie on paths through it."""
    staged = StagedTables()
    edges = staged(L.column_edges(_flat(spark, d)).select("src", "src_col", "dst", "dst_col"), "column-edges")
    columns = edges.select(F.col("src").alias("node"), F.col("src_col").alias("column")).union(edges.select("dst", "dst_col")).distinct()
    clicks = staged(columns.join(L.failing_nodes(_health(spark, d)), "node", "left_semi").withColumnRenamed("node", "object"), "clicks")
    found = R.paths(R.build(edges, asked=clicks), clicks)
    staged.discard(edges)
    return found.groupBy(F.concat_ws(".", "object", "column").alias("root")).agg(F.count(F.lit(1)).alias("edges"))


@query("impact_blast_radius", sql="""
WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM flat),
fail AS (SELECT object AS node FROM node_health WHERE failing_tests > 0),
t(root, node, depth) AS (SELECT node, node, 0 FROM fail
                         UNION SELECT t.root, e.dst, t.depth + 1 FROM t JOIN e ON e.src = t.node)
SELECT root, node, MIN(depth) AS hops FROM t WHERE depth > 0 GROUP BY root, node""")
def impact_blast_radius(spark, d):
    return L.blast_radius(_edges(spark, d), _health(spark, d))


@query("impact_sizes", sql="""
WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM flat),
fail AS (SELECT object AS node FROM node_health WHERE failing_tests > 0),
t(root, node) AS (SELECT node, node FROM fail UNION SELECT t.root, e.dst FROM t JOIN e ON e.src = t.node)
SELECT root, COUNT(*) - 1 AS reach, TRUE AS exact FROM t GROUP BY root""")
def impact_sizes(spark, d):
    """L6's overview: every failing node reaches fewer nodes here than a sketch holds, so the sizes are exact."""
    return L.impact_sizes(_edges(spark, d), _health(spark, d))


@query("latest_dq_result", sql="SELECT * FROM latest_dq")
def latest_dq_result(spark, d):
    return L.latest_dq(B.dq_results(spark, d))


@query("node_health_score", sql="SELECT * FROM node_health")
def node_health_score(spark, d):
    return _health(spark, d)


@query("join_dq_overlay", sql="""
SELECT m.object, m.kind, m.owner, h.tests, h.failing_tests, h.pass_ratio, h.last_checked,
  COALESCE(h.health, 'untested') AS health
FROM object_meta m LEFT JOIN node_health h ON m.object = h.object""")
def join_dq_overlay(spark, d):
    return L.overlay(B.object_meta(spark, d), _health(spark, d))


def _fresh_sql(col: str) -> str:
    fresh = AS_OF - _dt.timedelta(hours=T.FRESH_HOURS)
    late = AS_OF - _dt.timedelta(hours=T.LATE_HOURS)
    return (f"CASE WHEN {col} IS NULL THEN 'unknown' WHEN {col} >= TIMESTAMP '{fresh}' THEN 'fresh' "
            f"WHEN {col} >= TIMESTAMP '{late}' THEN 'late' ELSE 'stale' END")


@query("freshness_bucket", sql=f"SELECT object, last_checked, {_fresh_sql('last_checked')} AS freshness FROM node_health")
def freshness_bucket(spark, d):
    return L.freshness(_health(spark, d), AS_OF)


@query("lineage_node_overlay", sql=f"""
SELECT m.object, m.kind, m.owner, COALESCE(h.health, 'untested') AS health, h.pass_ratio,
  {_fresh_sql('h.last_checked')} AS freshness
FROM object_meta m LEFT JOIN node_health h ON m.object = h.object""")
def lineage_node_overlay(spark, d):
    """Node + kind + owner + DQ health + pass ratio + freshness, in one join."""
    from ..functions.scalar import freshness_bucket as fb
    o = L.overlay(B.object_meta(spark, d), _health(spark, d))
    return o.select("object", "kind", "owner", "health", "pass_ratio", fb("last_checked", AS_OF).alias("freshness"))


@query("sql_text_facts", sql="SELECT * FROM facts")
def sql_text_facts(spark, d):
    return L.sql_text_facts(B.query_text(spark, d))


@query("join_proc_children", sql="""
SELECT p.query_id AS parent_query_id, p.role AS parent_role, k.query_id AS child_query_id, k.role AS child_role
FROM query_log p JOIN query_log k ON k.parent_query_id = p.query_id""")
def join_proc_children(spark, d):
    return L.proc_children(B.query_log(spark, d))


_CALLS = """
calls(procedure, query_id, level) AS (SELECT parent_query_id, query_id, 1 FROM call_log WHERE parent_query_id IS NOT NULL
  UNION ALL SELECT calls.procedure, k.query_id, calls.level + 1 FROM calls JOIN call_log k ON k.parent_query_id = calls.query_id)"""
_OBJECTS = f"""{_CALLS},
touched AS (SELECT query_id, 'read' AS access, src AS object FROM lineage_edges UNION SELECT query_id, 'write', dst FROM lineage_edges),
scope AS (SELECT * FROM calls UNION SELECT procedure, procedure, 0 FROM calls),
objects AS (SELECT procedure, access, object, COUNT(DISTINCT query_id) AS queries, MIN(level) AS nearest_level
            FROM scope JOIN touched USING (query_id) GROUP BY procedure, access, object)"""


@query("procedure_calls", sql=f"WITH RECURSIVE {_CALLS} SELECT procedure, query_id, level FROM calls")
def procedure_calls(spark, d):
    """Every query below a procedure, at all levels of the call forest."""
    return L.call_closure(B.call_log(spark, d))


@query("procedure_objects", sql=f"WITH RECURSIVE {_OBJECTS} SELECT * FROM objects")
def procedure_objects(spark, d):
    """The objects each procedure reads and writes, by itself and through the queries below it."""
    return L.proc_objects(L.call_closure(B.call_log(spark, d)), L.touched_objects(B.access_log(spark, d)))


@query("procedure_profile", sql=f"""
WITH RECURSIVE {_OBJECTS},
below AS (SELECT procedure, COUNT(*) AS descendants, MAX(level) AS levels FROM calls GROUP BY procedure),
direct AS (SELECT parent_query_id, COUNT(*) AS children, array_to_string(list_sort(list(DISTINCT role)), ',') AS child_roles,
             MAX(query_id) AS last_child_query_id FROM call_log WHERE parent_query_id IS NOT NULL GROUP BY parent_query_id),
access AS (SELECT procedure, COUNT(*) FILTER (WHERE access = 'read') AS objects_read, COUNT(*) FILTER (WHERE access = 'write') AS objects_written
           FROM objects GROUP BY procedure)
SELECT d.*, b.descendants, b.levels, COALESCE(a.objects_read, 0) AS objects_read, COALESCE(a.objects_written, 0) AS objects_written
FROM direct d JOIN below b ON b.procedure = d.parent_query_id LEFT JOIN access a ON a.procedure = d.parent_query_id""")
def procedure_profile(spark, d):
    calls = B.call_log(spark, d)
    closure = L.call_closure(calls)
    return L.proc_profile(calls, closure, L.proc_objects(closure, L.touched_objects(B.access_log(spark, d))))


@query("join_edge_logic", sql="""
SELECT e.src, e.dst, e.query_id, f.join_logic, f.filter_logic, f.case_logic
FROM (SELECT DISTINCT src, dst, query_id FROM flat) e LEFT JOIN facts_by_query f ON e.query_id = f.query_id""")
def join_edge_logic(spark, d):
    per_edge = _flat(spark, d).select("src", "dst", "query_id").distinct()
    return per_edge.join(L.facts_by_query(L.sql_text_facts(B.query_text(spark, d))), "query_id", "left").select(
        "src", "dst", "query_id", "join_logic", "filter_logic", "case_logic")


@query("edge_logic", sql="""
SELECT e.src, e.dst, f.kind, f.fact, COUNT(DISTINCT e.query_id) AS queries
FROM (SELECT DISTINCT src, dst, query_id FROM flat) e LEFT JOIN facts f ON e.query_id = f.query_id
GROUP BY e.src, e.dst, f.kind, f.fact""")
def edge_logic(spark, d):
    return L.edge_logic(_flat(spark, d), L.sql_text_facts(B.query_text(spark, d)))
