"""Joins give the same results whether Spark broadcasts a side or not; the log is reduced first."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark import thresholds as T
from tidemark.operators import claims as C
from tidemark.operators import common
from tidemark.operators import lineage as L
from tidemark.plans import recovery as R
from tidemark.sources import bindings as B


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _without_broadcast(spark, make):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return _rows(make())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_merge_shuffle_path_equals_broadcast_path(spark):
    t = R.load_claims(spark, SF_SMALL, wide=False)
    ch = R.changes(t, T.CLAIMS_RUN_DATE)
    cols = ["recovery_date_closed", "recovery_status"]
    make = lambda: C.apply_updates(t.claimant, ch, "claimant_key", cols)
    assert _rows(make()) == _without_broadcast(spark, make)


def test_trace_shuffle_path_equals_broadcast_path(spark):
    e = L.object_edges(L.flatten_access(B.access_log(spark, SF_SMALL)))
    starts = L.source_nodes(e).select(F.col("node").alias("root"), "node")
    make = lambda: L.trace_keyed(e, starts, "down")
    assert _rows(make()) == _without_broadcast(spark, make)


def test_log_is_reduced_before_it_is_aggregated(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        R.changes(R.load_claims(spark, SF_SMALL, wide=False), T.CLAIMS_RUN_DATE).explain()
    plan = buf.getvalue()
    # the queue's claimants are staged; the log meets their keys below its aggregation
    assert re.search(r"BroadcastHashJoin .*LeftSemi", plan) and "c_name" not in plan


def test_dense_and_sparse_surrogates(spark):
    df = spark.range(0, 1000, 7).withColumnRenamed("id", "k").repartition(5)
    dense = common.dense_surrogate(df, "k", 10).orderBy("k").collect()
    assert [r["sequence_number"] for r in dense] == list(range(11, 11 + len(dense)))
    sparse = [r["sequence_number"] for r in common.sparse_surrogate(df, 10).collect()]
    assert len(set(sparse)) == len(sparse) and min(sparse) > 10
