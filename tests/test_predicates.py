"""NULL truth table of the recovery predicates (three-valued logic, never coalesced)."""

import pytest

from tidemark.functions import predicates as P

SCHEMA = ("salvage_status string, subrogation_status string, tp_deductible_status string, "
          "recovery_date_closed int, recovery_status string")


@pytest.mark.parametrize("row,all_closed,any_open,open_date,reopen", [
    (("C", "F", "W", 0, None), True, False, True, None),         # FALSE OR NULL is NULL
    ((None, "C", "F", 0, None), None, None, True, None),         # NULL + two closed: neither
    ((None, "X", "F", 20240101, None), False, True, False, True),  # NULL + one open: reopen
    (("X", "C", "C", None, "C"), False, True, True, True),       # NULL date passes only with 'C'
    (("X", "C", "C", None, None), False, True, True, None),      # NULL date, NULL status: unchanged
    (("N", "N", "N", None, "O"), True, False, True, None),
])
def test_truth_table(spark, row, all_closed, any_open, open_date, reopen):
    df = spark.createDataFrame([row], SCHEMA)
    r = df.select(P.all_closed().alias("a"), P.any_open().alias("b"), P.any_open_v0().alias("b0"),
                  P.is_open_date().alias("c"), P.needs_reopen().alias("d")).collect()[0]
    assert r["a"] == all_closed
    assert r["b"] == any_open
    assert r["b0"] == any_open  # De Morgan: the first variant's OR form is the same predicate
    assert r["c"] == open_date
    assert r["d"] == reopen


def test_transaction_codes_are_strings(spark):
    df = spark.createDataFrame([("7",), ("70",), ("11",), ("8 ",)], "transaction_code string")
    assert sorted(r[0] for r in P.recovery_txns(df).collect()) == ["11", "7"]
