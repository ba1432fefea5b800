"""Recovery predicates.  All keep SQL three-valued logic: a NULL status makes
the all-closed test NULL, and NULL never selects a row in a filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import thresholds as T

STATUS_COLUMNS = ("salvage_status", "subrogation_status", "tp_deductible_status")


def all_closed(cols=STATUS_COLUMNS, closed=T.CLOSED_STATUSES) -> Column:
    """Every status is a closed status."""
    out = None
    for c in cols:
        term = F.col(c).isin(*closed)
        out = term if out is None else out & term
    return out


def any_open(cols=STATUS_COLUMNS, closed=T.CLOSED_STATUSES) -> Column:
    """NOT P1 — deliberately no coalesce, so {NULL, closed, closed} is neither."""
    return ~all_closed(cols, closed)


def any_open_v0(cols=STATUS_COLUMNS, closed=T.CLOSED_STATUSES) -> Column:
    """P2 as the first variant writes it: a NOT IN S OR b NOT IN S OR ... (equal by De Morgan)."""
    out = None
    for c in cols:
        term = ~F.col(c).isin(*closed)
        out = term if out is None else out | term
    return out


def is_open_date(c: str = "recovery_date_closed") -> Column:
    """Close date NULL or 0."""
    return F.coalesce(F.col(c), F.lit(0)) == 0


def needs_reopen(date_col: str = "recovery_date_closed", status_col: str = "recovery_status") -> Column:
    """Date <> 0 OR status = 'C'; a NULL date passes only with status 'C'."""
    return (F.col(date_col) != 0) | (F.col(status_col) == T.STATUS_CLOSED)


def recovery_txns(stage: DataFrame, codes=T.RECOVERY_TXN_CODES) -> DataFrame:
    """P5: closing transactions; string codes. (A stored code column lets the test reach the scan; a computed one does not.)"""
    return stage.where(F.col("transaction_code").isin(*codes))


def enabled_bu(xref: DataFrame, flag: str = T.BU_ENABLED_FLAG) -> DataFrame:
    """Business units with the close-date flag set."""
    return xref.where(F.col("recovery_date_closed_rqd") == flag)
