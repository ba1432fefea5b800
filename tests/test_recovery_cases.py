"""Hand-made recovery cases on tiny in-memory tables (FIXTURES §3), plus the variant gaps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import claims as C
from tidemark.plans import recovery as R

RUN = dt.date(2024, 3, 1)
CLAIMANT = ("claimant_key bigint, claim_number string, claimant_number bigint, originating_business_unit string, "
            "salvage_status string, subrogation_status string, tp_deductible_status string, "
            "recovery_date_closed int, recovery_status string")
STAGE = ("business_unit string, claim_number string, claimant_number bigint, transaction_date int, "
         "transaction_code string, accounting_dt int, voucher_number bigint")
QUEUE = "originating_business_unit string, claim_number string, claimant_number bigint"
XREF = "business_unit string, recovery_date_closed_rqd string"


def tables(spark, claimants, txns, queue=None, xref=(("BU1", "Y"), ("BU2", "N"))):
    cl = spark.createDataFrame(claimants, CLAIMANT)
    if queue is None:
        queue = [(c[3], c[1], c[2]) for c in claimants]
    return R.ClaimTables(
        claimant=R._blank_to_null(cl),
        stage=R._blank_to_null(spark.createDataFrame(txns, STAGE)),
        queue=R._blank_to_null(spark.createDataFrame(queue, QUEUE)),
        xref=spark.createDataFrame(list(xref), XREF))


def by_key(df):
    return {r["claimant_key"]: r.asDict() for r in df.collect()}


def test_close_takes_newest_closing_txn_nulls_first(spark):
    t = tables(spark, [(1, "A", 1, "BU1", "C", "F", "W", 0, None)], [
        ("BU1", "A", 1, 20240110, "7", 20240105, 10),
        ("BU1", "A", 1, 20240101, "8", None, 5),       # NULL accounting_dt ranks first
        ("BU1", "A", 1, 20240201, "5", 20240201, 99),  # not a closing code, but counts for MAX
    ])
    ch = by_key(R.changes(t, RUN))
    assert ch[1]["update_type"] == "C"
    assert ch[1]["recovery_status"] == "C"
    assert ch[1]["recovery_date_closed"] == 20240101
    assert ch[1]["valid_from_date"] == 20240201


def test_voucher_breaks_accounting_ties_desc_nulls_first(spark):
    t = tables(spark, [(1, "A", 1, "BU1", "C", "C", "C", None, None)], [
        ("BU1", "A", 1, 20240110, "7", 20240105, 10),
        ("BU1", "A", 1, 20240111, "11", 20240105, None),
        ("BU1", "A", 1, 20240112, "8", 20240104, 50),
    ])
    assert by_key(R.changes(t, RUN))[1]["recovery_date_closed"] == 20240111


def test_no_closing_txn_v2_unchanged_v0_closes_with_null(spark):
    t = tables(spark, [(1, "A", 1, "BU1", "C", "F", "W", 0, None)], [("BU1", "A", 1, 20240110, "70", 1, 1)])
    assert R.changes(t, RUN).count() == 0
    lenient = by_key(R.close_set_lenient(t))
    assert lenient[1]["recovery_status"] == "C" and lenient[1]["recovery_date_closed"] is None


def test_reopen_without_transactions_uses_run_date(spark):
    t = tables(spark, [(1, "A", 1, "BU1", "X", "C", "C", None, "C"),
                       (2, "A", 2, "BU1", "X", "C", "C", None, None),     # guard NULL: unchanged
                       (3, "A", 3, "BU1", None, "C", "F", 0, "C"),        # NULL + closed: neither
                       (4, "A", 4, "BU1", "X", "C", "C", 20230101, "O")], [])
    ch = by_key(R.changes(t, RUN))
    assert set(ch) == {1, 4}
    assert ch[1]["recovery_status"] == "R" and ch[1]["recovery_date_closed"] == 0
    assert ch[4]["recovery_status"] == "O"
    assert ch[1]["valid_from_date"] == 20240301


def test_duplicate_queue_rows_give_one_change(spark):
    row = (1, "A", 1, "BU1", "X", "C", "C", 20230101, "C")
    t = tables(spark, [row], [], queue=[("BU1", "A", 1), ("BU1", "A", 1)])
    assert R.changes(t, RUN).count() == 1
    C.assert_unique(R.changes(t, RUN), "claimant_key")
    dup = R.changes(t, RUN).unionByName(R.changes(t, RUN))
    with pytest.raises(ValueError):
        C.assert_unique(dup, "claimant_key")


def test_disabled_business_unit_and_blank_status(spark):
    t = tables(spark, [(1, "A", 1, "BU2", "C", "C", "C", 0, None),
                       (2, "A", 2, "BU1", "", "C", "C", 0, None)], [("BU2", "A", 1, 20240101, "7", 1, 1)])
    # BU2 is not enabled; '' reads as NULL, so claimant 2 is neither closed nor reopened.
    assert R.changes(t, RUN).count() == 0


def test_merge_match_flag_writes_nulls_and_keeps_others(spark):
    t = tables(spark, [(1, "A", 1, "BU1", "C", "C", "C", 0, "O"),
                       (2, "A", 2, "BU1", "X", "C", "C", 5, "O")], [])
    src = spark.createDataFrame([(1, None, "C")], "claimant_key bigint, recovery_date_closed int, recovery_status string")
    out = by_key(C.apply_updates(t.claimant, src, "claimant_key", ["recovery_date_closed", "recovery_status"]))
    assert out[1]["recovery_date_closed"] is None and out[1]["recovery_status"] == "C"
    assert out[2]["recovery_date_closed"] == 5 and out[2]["recovery_status"] == "O"


def _fixture(spark):
    return tables(spark, [
        (1, "A", 1, "BU1", "C", "F", "W", 0, None),          # closes this run (has txn)
        (2, "A", 2, "BU1", "C", "F", "W", 20200101, "C"),    # closed in an earlier run, has txn
        (3, "A", 3, "BU1", "X", "F", "W", 20200101, "C"),    # reopens this run
        (4, "A", 4, "BU1", "C", "F", "W", None, None),       # no closing txn
    ], [("BU1", "A", 1, 20240110, "7", 20240105, 10), ("BU1", "A", 2, 20200101, "8", 20200101, 1)])


def test_rerun_on_updated_master_is_empty(spark):
    t = _fixture(spark)
    ch = R.changes(t, RUN)
    assert {r["claimant_key"] for r in ch.collect()} == {1, 3}
    updated = R.apply_changes(t.claimant, ch)
    assert updated.count() == t.claimant.count()
    t2 = R.ClaimTables(claimant=updated, stage=t.stage, queue=t.queue, xref=t.xref)
    assert R.changes(t2, RUN).count() == 0


def test_variant_history_gaps(spark):
    t = _fixture(spark)
    v2 = {r["claimant_key"] for r in R.changes(t, RUN).collect()}
    v1 = {r["claimant_key"] for r in R.history_candidates_v1(t, RUN).collect()}
    v0 = {r["claimant_key"] for r in R.history_candidates_v0(t, RUN).collect()}
    assert v2 == {1, 3}
    assert v1 == {1, 2}      # misses the reopen (3), adds the earlier closure (2)
    assert v0 == {4}         # misses real closures and reopens; only the NULL-dated lenient close


def test_history_rows_are_82_columns_with_dense_sequence(spark):
    from tidemark import thresholds as T
    from tidemark.sources import bindings as B
    t = _fixture(spark)
    wide = t.claimant.select(*[c if c in t.claimant.columns else F.lit(None).cast(B.claimant_types()[c]).alias(c)
                               for c in B.CLAIMANT_COLUMNS])
    t = R.ClaimTables(claimant=wide, stage=t.stage, queue=t.queue, xref=t.xref)
    h = R.history(R.changes(t, RUN), t.claimant, start_sequence=100).collect()
    assert len(h[0]) == 82 and list(h[0].asDict()) == list(T.HISTORY_COLUMNS)
    assert sorted((r["claimant_key"], r["sequence_number"]) for r in h) == [(1, 101), (3, 102)]
