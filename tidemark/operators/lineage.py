"""Lineage operators: flatten the access log, aggregate object / column edges,
trace recursively up or downstream, overlay data-quality results, and pull
join / filter / CASE snippets out of query text.

The recursive trace is a semi-naive loop of DataFrame joins: each round joins
only the newest frontier with the edges and removes already-visited nodes with
an anti join, so every round's work is proportional to the new nodes, a cycle
cannot loop forever, and the frontier never leaves the executors (the driver
only asks whether it is empty).  Each frontier is written with a reliable
``checkpoint()`` into the cluster's checkpoint folder, which keeps the plan
flat however deep the graph is and lets a lost executor's work be re-read
rather than recomputed from the first round.
"""

from __future__ import annotations

import datetime as _dt
import functools

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .. import thresholds as T
from ..functions import scalar as S
from ..functions.sqltext import clause_facts
from ..session import StagedRounds, checkpoint_dir, staged_table, reliable_checkpoint

#: Hops of a trace that are written together.  A hop's plan holds those of the hops before it several times over, each with joins that may be
#: broadcast, so the driver holds a small multiple of one hop's joins only with one hop a job.
HOPS = 1


# --------------------------------------------------------------------------- flatten + edges (S3, L1, L2)

def flatten_access(log: DataFrame) -> DataFrame:
    """S3: one row per (query, source column -> target column) from the nested write records."""
    w = log.select("query_id", "ts", F.explode_outer("writes").alias("w"))
    c = w.select("query_id", "ts", F.col("w.object").alias("dst"), F.explode_outer("w.columns").alias("wc"))
    s = c.select("query_id", "ts", "dst", F.col("wc.column").alias("dst_col"),
                 F.explode_outer("wc.sources").alias("s"))
    return s.select("query_id", "ts", F.col("s.object").alias("src"), F.col("s.column").alias("src_col"),
                    "dst", "dst_col")


def flatten_reads(log: DataFrame) -> DataFrame:
    """The read side: one row per (query, object, column) read."""
    r = log.select("query_id", "ts", F.explode_outer("reads").alias("r"))
    return r.select("query_id", "ts", F.col("r.object").alias("object"),
                    F.explode_outer("r.columns").alias("column_name"))


def _with_ends(flat: DataFrame) -> DataFrame:
    """A write without sources (or a source without a target) is a flattened row, but no edge."""
    return flat.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def object_edges(flat: DataFrame) -> DataFrame:
    """L1: de-duplicated object edges with first / last seen and the number of queries."""
    return (_with_ends(flat).groupBy("src", "dst")
                .agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"),
                     F.count_distinct("query_id").alias("query_count")))


def column_edges(flat: DataFrame) -> DataFrame:
    """L2: the same at column grain."""
    return (_with_ends(flat).groupBy("src", "src_col", "dst", "dst_col")
                .agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"),
                     F.count_distinct("query_id").alias("query_count")))


# --------------------------------------------------------------------------- recursive trace

def trace(edges: DataFrame, roots: DataFrame, direction: str = "down", max_depth: int | None = None) -> DataFrame:
    """L3 / L4: every node reachable from ``roots`` (column ``node``) with its minimum depth.

    ``edges`` has ``src`` / ``dst``; ``direction="up"`` walks them backwards.
    ``max_depth`` limits the hops when a caller wants a bounded trace; by
    default the loop runs until no new node appears (cycle-safe).
    """
    # One shared key: a node is visited once, at the first (= smallest) depth it is reached.
    out = trace_keyed(edges, roots.select(F.lit("*").alias("root"), "node"), direction, max_depth)
    return out.select("node", "depth")


def trace_keyed(edges: DataFrame, starts: DataFrame, direction: str = "down",
                max_depth: int | None = None) -> DataFrame:
    """Multi-source trace keyed by root: (root, node, depth), depth = fewest hops from that root.

    ``starts`` has columns ``root`` and ``node`` (usually equal).  Each hop:
    frontier ⋈ edges on node → new (root, node) pairs → anti join with the visited set.  A round writes
    ``HOPS`` hops with one reliable checkpoint; hops of a round share their exchanges.
    Rows per hop = genuinely new pairs only, and the driver sees just each hop's row count.  The edges stay where they lie.

    The visited set is a list of tables, each at least twice the next: a round's table is merged
    with those not larger than twice its size.  So a chain of any length rewrites a row a
    logarithmic number of times, and plans stay small.
    """
    checkpoint_dir(edges.sparkSession)
    a, b = ("src", "dst") if direction == "down" else ("dst", "src")
    # The edge list is read by every round: materialise it once (reliable checkpoint), dealt by the node as a join wants it, so that no hop moves it.
    # It is never broadcast: Spark knows no size of exploded rows, and what follows the graph in size must not pass the driver.
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    e = reliable_checkpoint(edges.select(F.col(a).alias("node"), F.col(b).alias("next")).distinct()
                            .repartition(parts, "node").sortWithinPartitions("node")).hint("merge")
    frontier = reliable_checkpoint(starts.select("root", "node").distinct().withColumn("depth", F.lit(0)))
    seen = [(frontier.count(), frontier)]
    depth = 0
    while seen[-1][0] > 0 and (max_depth is None or depth < max_depth):
        hops = HOPS if max_depth is None else min(HOPS, max_depth - depth)
        visited = functools.reduce(DataFrame.unionByName, [t.select("root", "node") for _, t in seen])
        found, last = [], frontier
        for hop in range(1, hops + 1):
            last = (last.join(e, "node").select("root", F.col("next").alias("node")).distinct()
                    .join(visited, ["root", "node"], "left_anti").withColumn("depth", F.lit(depth + hop)))
            visited = visited.unionByName(last.select("root", "node"))
            found.append(last)
        depth += hops
        # The row counts are observed while the checkpoint is written (no extra job).
        obs = Observation()
        rounds = reliable_checkpoint(functools.reduce(DataFrame.unionByName, found).observe(
            obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("depth") == depth).alias("last")))
        n, table, merged = obs.get["rows"], rounds, False
        if n == 0:
            break
        while seen and seen[-1][0] <= 2 * n:
            more, older = seen.pop()
            n, table, merged = n + more, older.unionByName(table), True
        seen.append((n, reliable_checkpoint(table) if merged else table))
        if obs.get["last"] == 0:
            break
        frontier = rounds.where(F.col("depth") == depth)
    return functools.reduce(DataFrame.unionByName, [t for _, t in seen])


def source_nodes(edges: DataFrame) -> DataFrame:
    """Nodes that no other node leads to (where downstream traces start); see ``root_components`` for those on cycles."""
    e = edges.where(F.col("src") != F.col("dst"))
    return edges.select(F.col("src").alias("node")).distinct().join(e.select(F.col("dst").alias("node")), "node", "left_anti")


def sink_nodes(edges: DataFrame) -> DataFrame:
    """Nodes that lead to no other node (where upstream traces start)."""
    return source_nodes(_reversed(edges))


def _reversed(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def smallest_ancestors(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node from which each node is reached, itself included.

    Labels travel along the edges; a round joins the edges with the labels that changed in the round before."""
    checkpoint_dir(edges.sparkSession)
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    rounds = StagedRounds("labels")
    labels = changed = rounds.next(nodes.select("node", F.col("node").alias("label")))
    while True:
        told = (changed.join(edges.withColumnRenamed("src", "node").hint("merge"), "node")
                .groupBy(F.col("dst").alias("node")).agg(F.min("label").alias("told")))
        obs = Observation()
        labels = rounds.next(
            labels.join(told, "node", "left").select("node", F.least("label", "told").alias("label"),
                                                     F.coalesce(F.col("told") < F.col("label"), F.lit(False)).alias("less"))
            .observe(obs, F.count_if("less").alias("rows")))
        if obs.get["rows"] == 0:
            return labels.select("node", "label")
        changed, labels = labels.where("less").select("node", "label"), labels.select("node", "label")


def cyclic_roots(edges: DataFrame) -> DataFrame:
    """(node, component): the nodes of strongly connected components that no edge enters from outside, in a graph where every node has
    a predecessor; ``component`` is the smallest node.

    A component without incoming edges is reached from itself only, so all its nodes carry its smallest node as label and lead back to it.
    Of the labels that name themselves, those whose component an edge enters are dropped."""
    labels = smallest_ancestors(edges)
    inside = (edges.join(labels.select(F.col("node").alias("src"), F.col("label").alias("a")), "src")
              .join(labels.select(F.col("node").alias("dst"), F.col("label").alias("b")), "dst").where(F.col("a") == F.col("b")).select("src", "dst"))
    back = trace(inside, labels.where(F.col("node") == F.col("label")).select("node"), "up").select("node")
    members = reliable_checkpoint(labels.join(back, "node", "left_semi").select("node", F.col("label").alias("component")))
    entered = (edges.join(members.select(F.col("node").alias("dst"), "component"), "dst")
               .join(members.select(F.col("node").alias("src"), F.col("component").alias("own")), "src", "left")
               .where(~F.col("own").eqNullSafe(F.col("component"))).select("component").distinct())
    return members.join(entered, "component", "left_anti").select("node", "component")


def trace_all(edges: DataFrame, direction: str = "down") -> DataFrame:
    """L3 / L4 from the roots of the whole graph: every node with its fewest hops from a root component.

    The graph's strongly connected components form an acyclic graph; its roots are the components that no edge enters, and all their nodes have depth 0.
    Single nodes are found first; only what they don't reach, which must lie on or behind cycles, is searched for cyclic roots.
    """
    e = reliable_checkpoint((edges if direction == "down" else _reversed(edges)).select("src", "dst").distinct())
    found = reliable_checkpoint(trace(e, source_nodes(e), "down"))
    nodes = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct()
    obs = Observation()
    rest = reliable_checkpoint(nodes.join(found, "node", "left_anti").observe(obs, F.count(F.lit(1)).alias("rows")))
    if obs.get["rows"] == 0:
        return found
    # a predecessor of an unreached node is unreached, so these edges are whole
    behind = reliable_checkpoint(e.join(rest.withColumnRenamed("node", "dst"), "dst", "left_semi").where(F.col("src") != F.col("dst")))
    more = trace(e, cyclic_roots(behind).select("node"), "down")
    return found.unionByName(more).groupBy("node").agg(F.min("depth").alias("depth"))


def paths_through(col_edges: DataFrame, obj: str, column: str) -> DataFrame:
    """Every column edge on some path through (obj, column): edges among its ancestors
    (and itself) plus edges among its descendants (and itself).  A node is the pair of object and column, so names with dots don't mix."""
    def node(o, c):
        return F.struct(o.alias("object"), c.alias("column"))

    ce = col_edges.select("src", "src_col", "dst", "dst_col", node(F.col("src"), F.col("src_col")).alias("a"), node(F.col("dst"), F.col("dst_col")).alias("b"))
    g = ce.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    me = col_edges.sparkSession.range(1).select(node(F.lit(obj), F.lit(column)).alias("node"))
    up = trace(g, me, "up").select("node")
    down = trace(g, me, "down").select("node")
    on_up = (ce.join(up.withColumnRenamed("node", "a"), "a", "left_semi")
               .join(up.withColumnRenamed("node", "b"), "b", "left_semi"))
    on_down = (ce.join(down.withColumnRenamed("node", "a"), "a", "left_semi")
                 .join(down.withColumnRenamed("node", "b"), "b", "left_semi"))
    return on_up.unionByName(on_down).select("src", "src_col", "dst", "dst_col").distinct()


def reach_sketches(edges: DataFrame, k: int = T.REACH_SKETCH_SIZE) -> DataFrame:
    """(node, hash): for every node the ``k`` smallest hashes of the nodes it leads to, itself included (a bottom-k sketch).

    Sketches travel against the edges: a round hands the hashes that were new in the last one to the nodes before, and each node keeps its ``k``
    smallest.  Keeping the smallest is idempotent, so cycles and shared paths need no care; no pair of nodes is ever made.  The
    limit by node is a WindowGroupLimit, so a node with very many successors is cut down before the shuffle.

    What the nodes hold is one array a node (8 bytes a hash) in a list of tables, each at least twice the next (see ``trace_keyed``), so a round
    writes its new hashes only and a hash is rewritten a logarithmic number of times.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    e = reliable_checkpoint(edges.where(F.col("src") != F.col("dst")).select(F.col("dst").alias("node"), F.col("src").alias("before")).distinct())
    new = reliable_checkpoint(e.select("node").union(e.select("before")).distinct().select("node", F.array(F.xxhash64("node")).alias("hashes")))
    held, none = [(new.count(), new)], F.array().cast("array<bigint>")
    smallest = Window.partitionBy("node").orderBy("hash")

    def joined(column: str):
        return F.flatten(F.collect_list(column)).alias(column)

    while held[-1][0] > 0:
        told = (new.join(e.hint("merge"), "node").select(F.col("before").alias("node"), F.explode("hashes").alias("hash")).distinct()
                .withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k).groupBy("node").agg(F.collect_list("hash").alias("told")))
        # grouped, not joined: joins of the rounds' tables would square Spark's estimate of their size (see StagedRounds)
        both = functools.reduce(DataFrame.unionByName, [t.select("node", "hashes", none.alias("told")) for _, t in held],
                                told.select("node", none.alias("hashes"), "told")).groupBy("node").agg(joined("hashes"), joined("told"))
        fresh = (both.where(F.size("told") > 0).withColumn("fresh", F.array_except("told", "hashes"))
                 .withColumn("kept", F.slice(F.sort_array(F.concat("hashes", "fresh")), 1, k))
                 .select("node", F.array_intersect("fresh", "kept").alias("hashes")).where(F.size("hashes") > 0))
        obs = Observation()
        new = reliable_checkpoint(fresh.observe(obs, F.coalesce(F.sum(F.size("hashes")), F.lit(0)).alias("rows")))
        n, table, merged = obs.get["rows"], new, False
        if n == 0:
            break
        while held and held[-1][0] <= 2 * n:
            more, older = held.pop()
            n, table, merged = n + more, older.unionByName(table), True
        held.append((n, reliable_checkpoint(_smallest_hashes(table, k)) if merged else table))
    return _smallest_hashes(functools.reduce(DataFrame.unionByName, [t for _, t in held]), k).select("node", F.explode("hashes").alias("hash"))


def _smallest_hashes(held: DataFrame, k: int) -> DataFrame:
    """One array a node with the ``k`` smallest of its hashes, which differ."""
    return held.groupBy("node").agg(F.slice(F.sort_array(F.flatten(F.collect_list("hashes"))), 1, k).alias("hashes"))


def reach_sizes(sketches: DataFrame, k: int = T.REACH_SKETCH_SIZE) -> DataFrame:
    """(node, reach, exact): how many other nodes each node leads to; exact below ``k`` nodes, else estimated with a
    relative error of about 1 / sqrt(k) by where the k-th smallest of evenly spread hashes lies."""
    n, span = F.count(F.lit(1)), 2.0 ** 64
    agg = sketches.groupBy("node").agg(n.alias("n"), F.max("hash").alias("last"))
    share = (F.col("last").cast("double") + F.lit(2.0 ** 63)) / F.lit(span)
    return agg.select("node", F.when(F.col("n") < k, F.col("n") - 1).otherwise(F.round(F.lit(k - 1.0) / share) - 1).cast("bigint").alias("reach"),
                      (F.col("n") < k).alias("exact"))


# --------------------------------------------------------------------------- data quality

def latest_dq(dq: DataFrame) -> DataFrame:
    """The latest outcome per (object, test): newest ts, then highest event id."""
    w = Window.partitionBy("object", "test").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return (dq.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
              .select("object", "test", "status", "score", "ts"))


def node_health(latest: DataFrame, green: float = T.HEALTH_GREEN, yellow: float = T.HEALTH_YELLOW) -> DataFrame:
    """Pass ratio of the latest results per object -> green / yellow / red."""
    agg = latest.groupBy("object").agg(
        F.count(F.lit(1)).alias("tests"),
        F.count(F.when(F.col("status") == "fail", True)).alias("failing_tests"),
        F.avg(F.when(F.col("status") == "pass", F.lit(1.0)).otherwise(F.lit(0.0))).alias("pass_ratio"),
        F.max("ts").alias("last_checked"))
    r = F.col("pass_ratio")
    return agg.withColumn("health", F.when(r >= green, F.lit("green")).when(r >= yellow, F.lit("yellow"))
                          .otherwise(F.lit("red")))


def overlay(nodes: DataFrame, health: DataFrame) -> DataFrame:
    """DQ status on every lineage node; untested nodes are kept, marked 'untested'."""
    return (nodes.join(health, "object", "left")
                 .withColumn("health", F.coalesce(F.col("health"), F.lit("untested"))))


def freshness(health: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """F14 over the latest DQ timestamps: fresh / late / stale."""
    return health.select("object", "last_checked", S.freshness_bucket("last_checked", as_of).alias("freshness"))


def failing_nodes(health: DataFrame) -> DataFrame:
    """Objects whose latest results include a failure."""
    return health.where(F.col("failing_tests") > 0).select(F.col("object").alias("node"))


def blast_radius(edges: DataFrame, health: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """Downstream objects of every failing node, keyed by the failing root, with hops: one row for each pair.
    ``roots`` (column ``node``) limits it to the failing nodes of interest; ``impact_sizes`` is the overview of all."""
    fail = failing_nodes(health)
    fail = fail if roots is None else fail.join(roots.select("node"), "node", "left_semi")
    t = trace_keyed(edges, fail.select(F.col("node").alias("root"), "node"), "down")
    return t.where(F.col("depth") > 0).select("root", "node", F.col("depth").alias("hops"))


def impact_sizes(edges: DataFrame, health: DataFrame, k: int = T.REACH_SKETCH_SIZE) -> DataFrame:
    """L6 as an overview: one row for each failing node with the number of objects downstream of it (0 for one without edges).

    A node's sketch follows from the nodes it leads to alone, so only edges that failing nodes lead to are looked at: a trace with one row a node finds them."""
    e, failing = staged_table(edges.where(F.col("src") != F.col("dst")).select("src", "dst"), "edges"), reliable_checkpoint(failing_nodes(health))
    below = trace(e, failing).select(F.col("node").alias("src"))
    reach = reach_sizes(reach_sketches(e.join(below, "src", "left_semi"), k), k)
    return failing.join(reach, "node", "left").select(
        F.col("node").alias("root"), F.coalesce("reach", F.lit(0).cast("bigint")).alias("reach"), F.coalesce("exact", F.lit(True)).alias("exact"))


# --------------------------------------------------------------------------- query text and procedures

def sql_text_facts(qtext: DataFrame) -> DataFrame:
    """JOIN conditions, WHERE filters and CASE expressions of each query, one row per snippet
    (see ``functions.sqltext`` for what counts as one)."""
    return qtext.select("query_id", F.inline(clause_facts(F.col("text"))))


def facts_by_query(facts: DataFrame) -> DataFrame:
    """One row per query with the snippets of each kind joined by '; ' (sorted), NULL where it has none."""
    def kind(k: str):
        return F.nullif(F.array_join(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("fact")))), "; "), F.lit(""))
    return facts.groupBy("query_id").agg(kind("join").alias("join_logic"), kind("filter").alias("filter_logic"),
                                         kind("case").alias("case_logic"))


def edge_logic(flat: DataFrame, facts: DataFrame) -> DataFrame:
    """Per object edge, each join / filter / CASE snippet of the queries that wrote it,
    with the number of such queries.  Long format: one row per (edge, kind, snippet), so an
    edge written by very many queries grows in rows, never into one unbounded cell; an edge
    without any snippet has one row of NULLs."""
    per_edge = _with_ends(flat).select("src", "dst", "query_id").distinct()
    return (per_edge.join(facts, "query_id", "left")
                    .groupBy("src", "dst", "kind", "fact")
                    .agg(F.count_distinct("query_id").alias("queries")))


def proc_children(qlog: DataFrame) -> DataFrame:
    """Parent procedure ↔ child queries (self join on parent id)."""
    parents = qlog.select(F.col("query_id").alias("parent_query_id"), F.col("role").alias("parent_role"))
    kids = qlog.where(F.col("parent_query_id").isNotNull()).select(
        "parent_query_id", F.col("query_id").alias("child_query_id"), F.col("role").alias("child_role"))
    return parents.join(kids, "parent_query_id", "inner")


def call_closure(qlog: DataFrame) -> DataFrame:
    """Every (procedure, query_id, level) of the call forest: all queries below a procedure, at any depth.

    Path doubling: a jump table leads each query to its ancestor 2^k calls up, and pairs up to 2^k levels apart
    become pairs up to 2^(k+1) apart in one join, so a chain of d calls takes log2(d) rounds.  A query that
    still has an ancestor after as many calls as there are queries lies on or below a circle of calls; such queries are left out.
    """
    spark = qlog.sparkSession
    checkpoint_dir(spark)
    first = reliable_checkpoint(qlog.where(F.col("parent_query_id").isNotNull())
                                .select("query_id", F.col("parent_query_id").alias("up")).distinct())
    jumps, n, reach = [first], first.count(), 1
    while reach <= n:
        obs = Observation()
        step = jumps[-1].withColumnRenamed("up", "mid").join(
            jumps[-1].select(F.col("query_id").alias("mid"), "up"), "mid").select("query_id", "up")
        # staged, as Spark's estimate of a checkpoint's size would be squared each round (see StagedRounds); all jumps are read again below
        step = staged_table(step.observe(obs, F.count(F.lit(1)).alias("rows")), "jumps")
        if obs.get["rows"] == 0:
            break
        jumps.append(step)
        reach *= 2
    if reach > n:  # whoever still has an ancestor is on or below a circle
        endless = jumps.pop().select("query_id")
        first = reliable_checkpoint(first.join(endless, "query_id", "left_anti"))
    pairs = first.select(F.col("up").alias("procedure"), "query_id", F.lit(1).alias("level"))
    for k, jump in enumerate(jumps):
        far = (jump.join(pairs.select(F.col("query_id").alias("up"), "procedure", "level"), "up")
               .select("procedure", "query_id", (F.col("level") + 2 ** k).alias("level")))
        pairs = reliable_checkpoint(pairs.unionByName(far))
    return pairs


def touched_objects(log: DataFrame) -> DataFrame:
    """(query_id, access, object): each object that a query reads or writes, once."""
    def side(column: str, access: str) -> DataFrame:
        return log.select("query_id", F.lit(access).alias("access"), F.explode(column).alias("x")).select("query_id", "access", F.col("x.object").alias("object"))
    return side("reads", "read").unionByName(side("writes", "write")).where(F.col("object").isNotNull()).distinct()


def proc_objects(closure: DataFrame, touched: DataFrame) -> DataFrame:
    """The objects that a procedure touches by itself (level 0) or through the queries below it, one row per
    procedure, access and object, with the number of such queries and the nearest level.

    Each pair of procedure and query is one row, so a procedure above very many queries is spread and partially aggregated."""
    own = closure.select("procedure").distinct().select("procedure", F.col("procedure").alias("query_id"), F.lit(0).alias("level"))
    return (closure.unionByName(own).join(touched, "query_id")
            .groupBy("procedure", "access", "object")
            .agg(F.count(F.lit(1)).alias("queries"), F.min("level").alias("nearest_level")))


def proc_profile(qlog: DataFrame, closure: DataFrame, objects: DataFrame) -> DataFrame:
    """Per procedure — direct children, their roles (sorted) and the last one; queries below it at all levels, the number
    of levels; objects read and written by it or below it."""
    direct = proc_children(qlog).groupBy(F.col("parent_query_id").alias("procedure")).agg(
        F.count(F.lit(1)).alias("children"),
        F.array_join(F.array_sort(F.collect_set("child_role")), ",").alias("child_roles"),
        F.max("child_query_id").alias("last_child_query_id"))
    below = closure.groupBy("procedure").agg(F.count(F.lit(1)).alias("descendants"), F.max("level").alias("levels"))
    access = objects.groupBy("procedure").agg(F.count_if(F.col("access") == "read").alias("objects_read"),
                                              F.count_if(F.col("access") == "write").alias("objects_written"))
    zero = F.lit(0).cast("bigint")
    return (direct.join(below, "procedure").join(access, "procedure", "left")
            .select(F.col("procedure").alias("parent_query_id"), "children", "child_roles", "last_child_query_id", "descendants", "levels",
                    F.coalesce("objects_read", zero).alias("objects_read"), F.coalesce("objects_written", zero).alias("objects_written")))


def catalog_objects(meta: DataFrame, cols: DataFrame) -> DataFrame:
    """Objects with kind, owner and their column list (sorted, comma-joined)."""
    c = cols.groupBy("object").agg(F.count(F.lit(1)).alias("n_columns"),
                                   F.array_join(F.array_sort(F.collect_list("column_name")), ",").alias("columns"))
    return meta.join(c, "object", "left")


def session_catalog(spark: SparkSession, databases: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """S4 from the session's catalogue: (objects, columns) for ``catalog_objects``.

    Objects are (object ``db.name``, kind table / view, owner; the database's owner where a table has none), columns (object,
    column_name, data_type).  What is read is metadata only, one look-up a table; a table that goes meanwhile is left out."""
    objects, columns = [], []
    for db in databases if databases is not None else [d.name for d in spark.catalog.listDatabases()]:
        of_db = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED `{db}`").collect()}
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                continue
            name = f"{db}.{t.name}"
            quoted = ".".join("`" + x.replace("`", "``") + "`" for x in (db, t.name))
            try:
                found = spark.catalog.listColumns(quoted)
                facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted}").collect()}
            except AnalysisException as e:
                if e.getCondition() not in ("TABLE_OR_VIEW_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND.WITHOUT_SUGGESTION"):
                    raise
                continue
            objects.append((name, "view" if t.tableType == "VIEW" else "table", facts.get("Owner") or of_db.get("Owner") or None))
            columns += [(name, c.name, c.dataType) for c in found]
    return (spark.createDataFrame(objects, "object string, kind string, owner string"),
            spark.createDataFrame(columns, "object string, column_name string, data_type string"))
