"""Publish-last runs, failure contract, history sequence continuity."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark import thresholds as T
from tidemark.plans import recovery as R
from tidemark.sources.sinks import current_run, published_history, write_report


def test_run_publishes_last_and_continues_sequence(spark):
    out = tempfile.mkdtemp(prefix="tidemark-test-run-")
    t = R.load_claims(spark, SF_SMALL, wide=True)
    first = R.run_recovery(spark, t, T.CLAIMS_RUN_DATE, out, run_id="run-a", parts=4, buckets=4)
    assert current_run(spark, out) == "run-a"
    summary = {r["step"]: r["row_count"] for r in spark.read.parquet(first["summary"]).collect()}
    n = summary["history"]
    assert n == summary["closed"] + summary["reopened"] == summary["updated"]
    snap = R.published_master(spark, out)
    want = R.apply_changes(t.claimant, R.changes(t, T.CLAIMS_RUN_DATE))
    assert snap.columns == want.columns and sorted(map(str, snap.collect())) == sorted(map(str, want.collect()))

    # Second run on the published master: nothing left to change, history keeps its numbers.
    t2 = R.ClaimTables(claimant=None, stage=t.stage, queue=t.queue, xref=t.xref)
    R.run_recovery(spark, t2, T.CLAIMS_RUN_DATE, out, run_id="run-b", parts=4, buckets=4)
    assert current_run(spark, out) == "run-b"
    hist = published_history(spark, out)
    assert hist.count() == n
    seq = hist.agg(F.min("sequence_number"), F.max("sequence_number"), F.countDistinct("sequence_number")).collect()[0]
    assert (seq[0], seq[1], seq[2]) == (1, n, n)
    assert R.published_master(spark, out).count() == t.claimant.count()


def test_failure_raises_fixed_error_and_publishes_nothing(spark):
    out = tempfile.mkdtemp(prefix="tidemark-test-fail-")
    t = R.load_claims(spark, SF_SMALL, wide=True)
    doubled = R.ClaimTables(claimant=t.claimant.unionByName(t.claimant), stage=t.stage, queue=t.queue, xref=t.xref)
    with pytest.raises(R.RecoveryError) as err:
        R.run_recovery(spark, doubled, T.CLAIMS_RUN_DATE, out, run_id="bad")
    assert err.value.code == -20039
    assert T.FATAL_ERROR_MESSAGE in str(err.value)
    assert current_run(spark, out) is None


@pytest.mark.parametrize("step", ["write_master", "write_history", "run_summary", "publish"])
def test_failure_at_any_step_leaves_nothing_visible(spark, monkeypatch, step):
    out = tempfile.mkdtemp(prefix="tidemark-test-step-")
    t = R.load_claims(spark, SF_SMALL, wide=True)

    def broken(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(R, step, broken)
        with pytest.raises(R.RecoveryError):
            R.run_recovery(spark, t, T.CLAIMS_RUN_DATE, out, run_id="again")
    assert published_history(spark, out) is None
    R.run_recovery(spark, t, T.CLAIMS_RUN_DATE, out, run_id="again")
    seen = published_history(spark, out)
    n, ids = seen.agg(F.count("*"), F.count_distinct("sequence_number")).first()
    assert n == ids == R.changes(t, T.CLAIMS_RUN_DATE).count()


def test_report_rerun_replaces_only_its_day(spark):
    import datetime as dt
    out = tempfile.mkdtemp(prefix="tidemark-test-report-")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "metric string, value long")
    write_report(df, out, "t", dt.date(2024, 1, 1))
    write_report(df, out, "t", dt.date(2024, 1, 2))
    write_report(df.limit(1), out, "t", dt.date(2024, 1, 2))
    got = {str(r["report_date"]): r["n"] for r in
           spark.read.parquet(out + "/t").groupBy("report_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"2024-01-01": 2, "2024-01-02": 1}
