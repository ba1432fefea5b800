"""Claims operators: queue resolution, latest transaction, max transaction date,
merge-by-key, and the history projection.

Everything is keyed by ``key3`` = (business unit, claim number, claimant
number), a fine-grained key: no single value can hold a large share of rows,
so the key3 shuffles are balanced; AQE's skew-join split covers the rest.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from .. import thresholds as T
from ..functions.predicates import enabled_bu, recovery_txns

KEY3 = ["originating_business_unit", "claim_number", "claimant_number"]
TXN_KEY3 = ["business_unit", "claim_number", "claimant_number"]


def _as_claimant_key3(stage: DataFrame) -> DataFrame:
    return stage.withColumnRenamed("business_unit", "originating_business_unit")


def enabled_queue(queue: DataFrame, xref: DataFrame) -> DataFrame:
    """J2 + P6: queue rows whose business unit is enabled (Spark broadcasts the filtered xref by its bytes)."""
    bu = enabled_bu(xref).select(F.col("business_unit").alias("originating_business_unit"))
    return queue.join(bu, "originating_business_unit", "left_semi")


def queue_claimants(queue: DataFrame, xref: DataFrame, claimant: DataFrame, distinct: bool = True) -> DataFrame:
    """Claimants on the enabled queue.

    ``distinct=True`` is a semi join (each claimant once however often it is
    queued — the DISTINCT of the first variant, for free); ``False`` is the
    plain inner join of the later variants, which repeats duplicated queue rows.
    """
    q = enabled_queue(queue, xref)
    if distinct:
        # Copies of a queue row collapse map-side (partial aggregation) before the shuffle,
        # so a claimant queued many times cannot load one reducer.
        return claimant.join(q.select(*KEY3).distinct(), KEY3, "left_semi")
    return claimant.join(q, KEY3, "inner")


def latest_txn(stage: DataFrame, codes=T.RECOVERY_TXN_CODES) -> DataFrame:
    """Newest closing transaction per key3 as ``row_number() = 1``.

    Order: accounting_dt DESC NULLS FIRST, voucher_number DESC NULLS FIRST,
    then transaction_date DESC so the pick is deterministic.  The code filter
    stays below the window (and reaches the scan); the rank-1 filter becomes a
    WindowGroupLimit, which also trims rows before the shuffle.
    """
    w = Window.partitionBy(*TXN_KEY3).orderBy(F.col("accounting_dt").desc_nulls_first(),
                                               F.col("voucher_number").desc_nulls_first(),
                                               F.col("transaction_date").desc())
    return (recovery_txns(stage, codes)
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .select(*TXN_KEY3, "transaction_date"))


def max_txn_date(stage: DataFrame) -> DataFrame:
    """A1: MAX(transaction_date) per key3 over all codes."""
    return stage.groupBy(*TXN_KEY3).agg(F.max("transaction_date").alias("max_transaction_date"))


# Digits of each part of the packed ordering key (see ``txn_order_key``).
_DATE_DIGITS = 8           # yyyymmdd, NUMBER(8) in the source schema
_VOUCHER_DIGITS = 20       # a signed 64-bit voucher shifted by 2**63 to be non-negative


def txn_order_key(acc="accounting_dt", voucher="voucher_number", tdate="transaction_date"):
    """The W1 ordering as one ``decimal(38,0)`` so that ``max`` of it is the row ranked first.

    Digits, high to low: [accounting_dt is NULL][accounting_dt][voucher is NULL]
    [voucher + 2^63][transaction_date + 1, 0 when NULL].  NULL flags are 1 so NULLs sort
    first under DESC, as the source dialect does; the date is the tie-break and sorts last when NULL.  A decimal aggregation buffer is
    mutable, so Spark plans a hash aggregate with map-side partial
    aggregation; ``max`` of a struct would force a sort-based aggregate.
    """
    def d(c):
        return F.col(c).cast("decimal(38,0)")

    def n(v: int):
        return F.lit(Decimal(v)).cast("decimal(38,0)")

    shift_v = 10 ** _DATE_DIGITS
    shift_vn = shift_v * 10 ** _VOUCHER_DIGITS
    shift_a = shift_vn * 10
    shift_an = shift_a * 10 ** _DATE_DIGITS
    acc_null = F.col(acc).isNull().cast("int").cast("decimal(38,0)")
    voucher_null = F.col(voucher).isNull().cast("int").cast("decimal(38,0)")
    voucher_pos = F.coalesce(d(voucher) + n(2 ** 63), n(0))
    key = (acc_null * n(shift_an) + F.coalesce(d(acc), n(0)) * n(shift_a)
           + voucher_null * n(shift_vn) + voucher_pos * n(shift_v) + F.coalesce(d(tdate) + n(1), n(0)))
    return key.cast("decimal(38,0)")


def txn_summary(stage: DataFrame, keys: DataFrame | None = None, codes=T.RECOVERY_TXN_CODES, latest: bool = True) -> DataFrame:
    """W1 + A1 in one aggregation: one shuffle of the transaction log instead of two.

    The newest closing transaction is the maximum packed ordering key among
    closing codes; its last 8 digits are that row's transaction date.  Partial
    aggregation runs map-side, so a key3 with many transactions is reduced to
    one row per task before the shuffle.  ``keys`` (distinct key3) limits the log to
    the rows that are wanted before it is aggregated.  Over a log kept in buckets of key3 (``sources.bucketed``) neither the limit nor the
    aggregation moves a row of it.  ``latest=False`` asks for A1 only.
    """
    log = _as_claimant_key3(stage)
    if keys is not None:
        log = log.join(keys, KEY3, "left_semi")
    high = F.max("transaction_date").alias("max_transaction_date")
    if not latest:
        return log.groupBy(*KEY3).agg(high)
    is_closing = F.col("transaction_code").isin(*codes)
    newest = F.max(F.when(is_closing, txn_order_key())).alias("_latest")
    slot = F.col("_latest") % F.lit(10 ** _DATE_DIGITS)
    return (log.groupBy(*KEY3)
            .agg(newest, high)
            .select(*KEY3,
                    F.when(slot > 0, slot - 1).cast("int").alias("latest_txn_date"),
                    F.col("_latest").isNotNull().alias("has_recovery_txn"),
                    "max_transaction_date"))


def join_latest(df: DataFrame, stage: DataFrame, codes=T.RECOVERY_TXN_CODES) -> DataFrame:
    """Inner join to the newest closing transaction (no closing transaction -> dropped)."""
    lt = _as_claimant_key3(latest_txn(stage, codes)).withColumnRenamed("transaction_date", "latest_txn_date")
    return df.join(lt, KEY3, "inner")


def latest_txn_or_null(df: DataFrame, stage: DataFrame, codes=T.RECOVERY_TXN_CODES) -> DataFrame:
    """Correlated top-1 scalar subquery as a left join — NULL when there is none."""
    lt = _as_claimant_key3(latest_txn(stage, codes)).withColumnRenamed("transaction_date", "latest_txn_date")
    return df.join(lt, KEY3, "left")


def with_max_txn(df: DataFrame, stage: DataFrame) -> DataFrame:
    """J8 / J4 (first half): correlated MAX as a grouped left join."""
    return df.join(_as_claimant_key3(max_txn_date(stage)), KEY3, "left")


def with_valid_from(df: DataFrame, stage: DataFrame, run_date_int) -> DataFrame:
    """Left join to per-key MAX, missing -> the run date as yyyymmdd."""
    return (with_max_txn(df, stage)
            .withColumn("valid_from_date", F.coalesce(F.col("max_transaction_date"), run_date_int).cast("int")))


def in_keys(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """``WHERE key IN (subquery)`` as a left semi join."""
    return df.join(keys, on, "left_semi")


def exists_flag(df: DataFrame, stage: DataFrame, codes=T.RECOVERY_TXN_CODES, col: str = "has_recovery_txn") -> DataFrame:
    """EXISTS (closing transaction) as a boolean column, usable inside an OR.

    The keys are de-duplicated by an aggregation (partial, map-side) before the
    left join, so the join cannot multiply rows.
    """
    keys = (_as_claimant_key3(recovery_txns(stage, codes)).select(*KEY3).distinct()
            .withColumn("_hit", F.lit(True)))
    return (df.join(keys, KEY3, "left")
              .withColumn(col, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))


def apply_updates(target: DataFrame, src: DataFrame, key: str, set_cols, matched: Observation | None = None) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE SET, as a left join + match flag.

    A matched row takes the source value even when it is NULL (a match flag,
    not coalesce); unmatched rows pass through unchanged.  Column order of the
    target is kept.  Spark picks the join by the source's bytes (at run time with AQE); a target
    in buckets of the key is not moved by any of them.  ``matched`` observes the number of updated rows (``rows``).
    """
    renamed = src.select(F.col(key), *[F.col(c).alias(f"_src_{c}") for c in set_cols],
                         F.lit(True).alias("_matched"))
    joined = target.join(renamed, key, "left")
    if matched is not None:
        joined = joined.observe(matched, F.count("_matched").alias("rows"))
    out = []
    for c in target.columns:
        if c in set_cols:
            out.append(F.when(F.col("_matched"), F.col(f"_src_{c}")).otherwise(F.col(c))
                       .cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def assert_unique(df: DataFrame, key: str) -> None:
    """Refuse a change set with two rows for one target key (a MERGE would be ambiguous)."""
    dup = df.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"change set has more than one row for {key}={dup[0][key]}")


def cardinality_report(df: DataFrame, key: str) -> DataFrame:
    """R9 as data: rows, distinct keys and duplicated keys of a change set (one row)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.sum("_n").cast("bigint").alias("rows"),
                       F.count(F.lit(1)).alias("distinct_keys"),
                       F.count(F.when(F.col("_n") > 1, True)).alias("duplicate_keys"))


def to_history(df: DataFrame) -> DataFrame:
    """The 82 history columns selected by name from the one fixed list."""
    return df.select(*T.HISTORY_COLUMNS)
