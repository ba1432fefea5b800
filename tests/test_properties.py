"""Properties of whole-table jobs on the sf0.001 fixture tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark import thresholds as T
from tidemark.operators import kpi as K
from tidemark.plans import recovery as R
from tidemark.sources import bindings as B


def test_close_and_reopen_are_disjoint_and_rerun_is_empty(spark):
    t = R.load_claims(spark, SF_SMALL, wide=False)
    close = {r[0] for r in R.close_set(t, T.CLAIMS_RUN_DATE).select("claimant_key").collect()}
    reopen = {r[0] for r in R.reopen_set(t, T.CLAIMS_RUN_DATE).select("claimant_key").collect()}
    assert close and reopen and not (close & reopen)
    ch = R.changes(t, T.CLAIMS_RUN_DATE)
    updated = R.apply_changes(t.claimant, ch)
    assert updated.count() == t.claimant.count()
    # rows outside the change set are unchanged
    before = t.claimant.join(ch.select("claimant_key"), "claimant_key", "left_anti")
    after = updated.join(ch.select("claimant_key"), "claimant_key", "left_anti")
    assert before.exceptAll(after).count() == 0
    t2 = R.ClaimTables(claimant=updated, stage=t.stage, queue=t.queue, xref=t.xref)
    assert R.changes(t2, T.CLAIMS_RUN_DATE).count() == 0


def test_exclusive_rejections_sum_to_rejected(spark):
    st = K.account_stages(B.account_flags(spark, SF_SMALL))
    rej = K.rejections(st).groupBy("product").agg(F.sum("accounts").alias("s"))
    fun = K.funnel(st).select("product", (F.col("total_accounts") - F.col("eligible_accounts")).alias("r"))
    for row in rej.join(fun, "product").collect():
        assert row["s"] == row["r"]


def test_shares_sum_to_100(spark):
    st = K.account_stages(B.account_flags(spark, SF_SMALL))
    for row in K.share(K.funnel(st)).groupBy("metric").agg(F.sum("share_pct").alias("s")).collect():
        assert abs(row["s"] - 100.0) <= 0.2


def test_combo_volumes_count_each_account_once(spark):
    q = B.quotes(spark, SF_SMALL)
    vol = K.combo_volume(q)
    assert vol.count() == 7
    assert vol.agg(F.sum("accounts")).collect()[0][0] == q.select("account_id").distinct().count()
    by_month = K.combo_volume_by_month(q).agg(F.sum("accounts")).collect()[0][0]
    assert by_month == q.select("account_id", F.date_trunc("month", "quoted_on")).distinct().count()


def test_two_critical_metrics_of_a_product_are_one_anomaly(spark):
    from tidemark.plans import reports as Rp
    rows = [("S", "Cargo", "a", "critical"), ("S", "Cargo", "b", "critical"), ("S", "Hull", "a", "warning"), ("T", "Crime", "a", "normal")]
    df = spark.createDataFrame(rows, "section string, product string, metric string, level string")
    got = {r["section"]: (r["critical_products"], r["critical_metrics"], r["warning_metrics"], r["status"]) for r in Rp.health_rollup(df).collect()}
    assert got == {"S": (1, 2, 1, "1 Anomaly"), "T": (0, 0, 0, "Healthy")}


def test_metric_missing_today_is_a_critical_drop(spark):
    import datetime as dt
    from tidemark.plans import reports as Rp
    day = dt.date(2024, 1, 10)
    rows = [(day - dt.timedelta(days=i), "S", "P", "m", 10) for i in range(1, 6)]
    daily = spark.createDataFrame(rows, "report_date date, section string, product string, metric string, value long")
    expected = spark.createDataFrame([("S", "P", "m"), ("S", "P", "silent")], "section string, product string, metric string")
    got = {r["metric"]: (r["today"], r["var_7d_pct"], r["level"]) for r in Rp.kpi_anomalies(daily, day, expected).collect()}
    assert got == {"m": (0, -100.0, "critical"), "silent": (0, None, None)}


def test_downstream_trace_reaches_every_node(spark):
    from tidemark.operators import lineage as L
    e = L.object_edges(L.flatten_access(B.access_log(spark, SF_SMALL)))
    nodes = e.select(F.col("src").alias("node")).union(e.select(F.col("dst").alias("node"))).distinct().count()
    down = L.trace(e, L.source_nodes(e), "down")
    assert down.count() == nodes
    assert down.select("node").distinct().count() == nodes
