"""Bucketed master and log: merges by part, no exchange of the large side, one scan for many runs."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark import thresholds as T
from tidemark.operators import claims as C
from tidemark.plans import recovery as R
from tidemark.sources import sinks
from tidemark.sources.bucketed import BucketedTable


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _above_scan(df, column):
    """The operators between the top and the scan that reads ``column`` of a Spark table, top first."""
    path = []

    def walk(node, above):
        name = node.nodeName()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if not children and column in node.toString() and "tidemark_" in node.toString():
            path.append(above)
        for c in children:
            walk(c, [*above, name])

    walk(df._jdf.queryExecution().executedPlan(), [])
    assert len(path) == 1, path
    return path[0]


def _masters(spark, n=400):
    schema = R.master_table("x").schema
    have = {"claimant_key": F.col("id"), "recovery_status": F.lit("O"), "claimant_name": F.concat(F.lit("n"), F.col("id").cast("string"))}
    return spark.range(n).select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def _change(spark, rows):
    return spark.createDataFrame(rows, "claimant_key long, recovery_date_closed int, recovery_status string")


def test_merge_rewrites_only_the_touched_parts(spark):
    root = tempfile.mkdtemp(prefix="tidemark-test-master-")
    table = R.master_table(root, parts=4, buckets=4)
    first, _ = R.write_master(spark, table, _masters(spark), _change(spark, []), "v1")
    assert first == {p: ["v1"] for p in range(4)}
    part = table.parts_of(spark.createDataFrame([(17,)], "claimant_key long"))
    second, updated = R.merge_master(spark, table, first, _change(spark, [(17, 20240101, "C")]), "v2")
    assert updated == 1 and second == {**first, part[0]: ["v2"]}
    new = [d for d, _, files in os.walk(table.root) if "version=v2" in d and any(f.endswith(".parquet") for f in files)]
    assert new == [f"{table.root}/part={part[0]}/version=v2"]
    rows = {r["claimant_key"]: r for r in table.read(spark, second).collect()}
    assert len(rows) == 400 and (rows[17]["recovery_date_closed"], rows[17]["recovery_status"], rows[17]["claimant_name"]) == (20240101, "C", "n17")
    assert all(rows[k]["recovery_status"] == "O" for k in rows if k != 17)
    assert {r["claimant_key"]: r["recovery_status"] for r in table.read(spark, first).collect()}[17] == "O"  # the old version stands
    third, updated = R.merge_master(spark, table, second, _change(spark, []), "v3")
    assert third == second and updated == 0
    unknown, updated = R.merge_master(spark, table, second, _change(spark, [(9999, 1, "C")]), "v4")
    assert updated == 0 and table.read(spark, unknown).count() == 400
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def test_master_is_not_exchanged_by_a_merge(spark, no_broadcast):
    table = R.master_table(tempfile.mkdtemp(prefix="tidemark-test-master-"), parts=2, buckets=4)
    manifest, _ = R.write_master(spark, table, _masters(spark), _change(spark, []), "v1")
    with table.opened(spark, manifest) as name:
        merged = C.apply_updates(spark.table(name).drop("part", "version"), _change(spark, [(1, 5, "C")]), "claimant_key", R.UPDATED_COLUMNS)
        above = _above_scan(merged, "claimant_name")
        assert "SortMergeJoin" in above and not [n for n in above if "Exchange" in n], above
        assert merged.where("recovery_status = 'C'").count() == 1


def test_bucketed_log_is_not_exchanged(spark, no_broadcast):
    t = R.load_claims(spark, SF_SMALL, wide=False)
    log = BucketedTable(tempfile.mkdtemp(prefix="tidemark-test-log-") + "/log", t.stage.schema, tuple(C.TXN_KEY3), parts=1, buckets=4)
    half = F.col("transaction_date") % 2 == 0
    log.append(spark, t.stage.where(half), "day1")
    log.append(spark, t.stage.where(~half), "day2")
    want = {tuple(r) for r in R.changes(t, T.CLAIMS_RUN_DATE).collect()}
    keys = t.claimant.select(*C.KEY3).where("claimant_number = 1")
    with log.opened(spark, {0: ["day1", "day2"]}) as name:
        stage = spark.table(name).drop("part", "version")
        for summary in (C.txn_summary(stage), C.txn_summary(stage, keys)):
            above = _above_scan(summary, "voucher_number")
            assert not [n for n in above if "Exchange" in n], above
        got = {tuple(r) for r in R.changes(R.ClaimTables(t.claimant, stage, t.queue, t.xref), T.CLAIMS_RUN_DATE).collect()}
    assert got == want


def test_a_thousand_runs_are_one_scan(spark):
    out = tempfile.mkdtemp(prefix="tidemark-test-runs-")
    rows = spark.range(1002).selectExpr("concat('r', id) AS run_id", "cast(20240100 + id % 28 AS int) AS valid_from_date", "id AS sequence_number", "202401 AS valid_from_month")
    rows.repartition(4, "run_id").write.partitionBy("run_id").parquet(out + "/history")
    log = spark.range(1000).selectExpr("cast(id AS string) AS published_at", "concat('r', id) AS run_id", "id AS max_sequence",
                                       "array(named_struct('part', 0, 'version', concat('v', id))) AS master")
    log.withColumn("published_at", F.lpad("published_at", 20, "0")).coalesce(1).write.json(out + "/published/entry=all")
    hist = sinks.published_history(spark, out)
    assert hist.count() == 1000 and hist.where("run_id IN ('r1000', 'r1001')").count() == 0
    plan = hist._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan and "PartitionFilters: [" in plan and "run_id" in plan
    last = sinks.last_published(spark, out)
    assert (last.run_id, last.max_sequence, last.master) == ("r999", 999, {0: ["v999"]}) and len(sinks.published_runs(spark, out)) == 1000


def test_published_run_is_refused_and_stays(spark):
    out = tempfile.mkdtemp(prefix="tidemark-test-refuse-")
    t = R.load_claims(spark, SF_SMALL, wide=True)
    R.run_recovery(spark, t, T.CLAIMS_RUN_DATE, out, run_id="r", parts=2, buckets=2)
    before = sinks.published_history(spark, out).count()
    with pytest.raises(R.RecoveryError, match="published"):
        R.run_recovery(spark, t, T.CLAIMS_RUN_DATE, out, run_id="r", parts=2, buckets=2)
    assert sinks.published_history(spark, out).count() == before and sinks.published_runs(spark, out) == ["r"]
    with pytest.raises(R.RecoveryError, match="no master"):
        R.run_recovery(spark, R.ClaimTables(None, t.stage, t.queue, t.xref), T.CLAIMS_RUN_DATE, out + "/other", run_id="x")


def test_summary_counts_the_rows_written(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="tidemark-test-summary-")
    t = R.load_claims(spark, SF_SMALL, wide=True)
    right = R.changes

    def with_a_stranger(tables, run_date):  # a change whose claimant the master doesn't have
        rows = right(tables, run_date)
        return rows.unionByName(rows.limit(1).withColumn("claimant_key", F.lit(-5).cast("long")))

    monkeypatch.setattr(R, "changes", with_a_stranger)
    res = R.run_recovery(spark, t, T.CLAIMS_RUN_DATE, out, run_id="r", parts=2, buckets=2)
    got = {r["step"]: r["row_count"] for r in spark.read.parquet(res["summary"]).collect()}
    n = sinks.published_history(spark, out).count()
    assert got["updated"] == got["history"] == n == res["changes"] - 1 == got["closed"] + got["reopened"] - 1
