"""What must not grow: planned sizes of loops, what passes the driver, rows of one task."""

import os
import tempfile

from conftest import SF_SMALL
from pyspark.sql import functions as F
from tidemark import thresholds as T
from tidemark.operators import lineage as L
from tidemark.operators import reach_index as R
from tidemark.plans import recovery
from tidemark.sources import bindings as B
from tidemark.sources import sinks


def _bits(df):
    """Digits of Spark's estimate of a frame's size."""
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length()


def test_estimates_are_not_squared_each_round(spark):
    chain = spark.range(60).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    places = R.tour(chain)
    assert _bits(places) < 400 and places.agg(F.count("*"), F.max(F.col("hi") - F.col("lo"))).first() == (60, 119)
    edges = spark.range(1, 40).select((F.col("id") - 1).alias("src"), F.col("id").alias("dst"))
    assert _bits(L.smallest_ancestors(edges.where("dst < 8"))) < 400
    calls = L.call_closure(edges.select(F.col("dst").alias("query_id"), F.col("src").alias("parent_query_id")))
    assert _bits(calls) < 800 and calls.count() == 40 * 39 // 2


def test_lookups_make_no_row_that_is_no_result(spark):
    chain = [(f"T{i}", "c", f"T{i + 1}", "c") for i in range(200)]
    index = R.build(spark.createDataFrame(chain, "src string, src_col string, dst string, dst_col string"))
    found = R.paths(index, spark.createDataFrame([(f"T{i}", "c") for i in (0, 77, 200)], "object string, column string"))
    assert [j for j in str(found._jdf.queryExecution().optimizedPlan()).splitlines() if "Join" in j and (" <= " in j or " >= " in j)] == []
    assert {r["object"]: r["count"] for r in found.groupBy("object").count().collect()} == {"T0": 200, "T77": 200, "T200": 200}
    assert not index.covers.where("cyclic").count()


def test_edges_of_a_trace_stay_where_they_lie(spark, monkeypatch):
    hops, right = [], L.reliable_checkpoint
    monkeypatch.setattr(L, "reliable_checkpoint", lambda df: hops.append(df) or right(df))
    edges = spark.createDataFrame([(f"T{i}", f"T{i // 2}") for i in range(1, 40)], "src string, dst string")
    assert L.trace(edges, spark.createDataFrame([("T37",)], "node string")).count() == 7
    joins = [j for df in hops for j in str(df._jdf.queryExecution().optimizedPlan()).splitlines() if "Join Inner" in j]
    assert joins and all("strategy=merge" in j for j in joins)


def test_sketches_write_what_is_new_below_failing_nodes_only(spark, monkeypatch):
    written, right, asked, sketches = [], L.reliable_checkpoint, [], L.reach_sketches
    monkeypatch.setattr(L, "reliable_checkpoint", lambda df: written.append(right(df)) or written[-1])
    n = 24
    chain = spark.range(n).select(F.concat(F.lit("T"), "id").alias("src"), F.concat(F.lit("T"), F.col("id") + 1).alias("dst"))
    assert {(r["node"], r["reach"], r["exact"]) for r in L.reach_sizes(L.reach_sketches(chain)).collect()} == {(f"T{i}", n - i, True) for i in range(n + 1)}
    hashes = sum(df.count() if "hash" in df.columns else df.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0] for df in written if {"hash", "hashes"} & {*df.columns})
    assert hashes < 6 * n * (n + 1) // 2
    monkeypatch.setattr(L, "reach_sketches", lambda edges, k: asked.append(edges) or sketches(edges, k))
    health = spark.createDataFrame([("T21", 1), ("T22", 2), ("T24", 1), ("T5", 0), (None, 1), ("lonely", 3)], "object string, failing_tests long")
    want = {("T21", 3, True), ("T22", 2, True), ("T24", 0, True), (None, 0, True), ("lonely", 0, True)}
    assert {tuple(r) for r in L.impact_sizes(chain.unionByName(chain), health).collect()} == want
    assert {r["src"] for r in asked[0].collect()} == {"T21", "T22", "T23"}


def test_a_narrow_table_is_dealt_out_before_it_widens(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert B.access_log(spark, SF_SMALL).rdd.getNumPartitions() == B.query_text(spark, SF_SMALL).rdd.getNumPartitions() == n > 1


def test_buckets_follow_the_rows_and_runs_share_them(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="tidemark-test-buckets-")
    t = recovery.load_claims(spark, SF_SMALL, wide=True)
    n = t.claimant.count()
    monkeypatch.setattr(recovery, "BUCKET_ROWS", -(-n // 30))
    recovery.run_recovery(spark, t, T.CLAIMS_RUN_DATE, out, run_id="r1", parts=2)
    assert sinks.last_published(spark, out).buckets == 32
    monkeypatch.setattr(recovery, "BUCKET_ROWS", n)
    recovery.run_recovery(spark, recovery.ClaimTables(None, t.stage, t.queue, t.xref), T.CLAIMS_RUN_DATE, out, run_id="r2", parts=2)
    assert sinks.last_published(spark, out).buckets == 32
    files = [f for d, _, fs in os.walk(out + "/master") for f in fs if f.endswith(".parquet")]
    assert len({f.split("_")[1].split(".")[0] for f in files}) > 8
    assert recovery.published_master(spark, out).count() == n


def test_path_sizes_write_what_failing_columns_lead_to_and_leave_no_shuffles(spark, tmp_path):
    from tidemark import session
    from tidemark.plans.registry import load_all

    n = 1500
    spark.range(n).select(F.col("id").alias("p_partkey"), (F.col("id") * 7 % 50).cast("int").alias("p_size")).write.parquet(f"{tmp_path}/part.parquet")
    fails = {3: 300.0, 40: 250.0, 41: 10.0, 900: 201.0, 5000: 400.0}
    spark.createDataFrame([(k, k, "view", v) for k, v in fails.items()], "event_id long, user_id long, event_type string, value double").select(
        "event_id", F.lit("2024-01-02 03:04:05").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value").write.parquet(f"{tmp_path}/events.parquet")
    edges = {((r["src"], r["src_col"]), (r["dst"], r["dst_col"])) for r in L.column_edges(L.flatten_access(B.access_log(spark, str(tmp_path)))).collect()}

    def reached(start, side):
        seen, todo = {start}, [start]
        while todo:
            at = todo.pop()
            new = {e[1 - side] for e in by[side].get(at, ())} - seen
            seen |= new
            todo += new
        return seen

    by = [{}, {}]
    for e in edges:
        by[0].setdefault(e[0], []).append(e)
        by[1].setdefault(e[1], []).append(e)
    want, pairs = {}, 0
    for node in [(f"T{k}", f"c{i}") for k in (3, 40, 900) for i in (1, 2, 3)]:
        down, up = reached(node, 0), reached(node, 1)
        want[".".join(node)], pairs = sum(a in down or b in up for a, b in edges), pairs + len(down) + len(up)

    def bytes_in(folders, start):
        return sum(os.path.getsize(os.path.join(d, f)) for folder in folders for d, _, fs in os.walk(folder) for f in fs if f.startswith(start))

    local = [f.getPath() for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    held = [session.checkpoint_dir(spark).removeprefix("file:")]
    spark.sparkContext._jvm.System.gc()
    before = bytes_in(local, "shuffle_"), bytes_in(held, "part-")
    sizes = load_all()["lineage_path_sizes"].build(spark, str(tmp_path))
    shuffles, tables = bytes_in(local, "shuffle_") - before[0], bytes_in(held, "part-") - before[1]
    assert spark.conf.get(session.DROPS_SHUFFLES, None) is None
    assert shuffles < 50_000 and tables < 40 * (len(edges) + pairs)
    assert {r["root"]: r["edges"] for r in sizes.collect()} == want
