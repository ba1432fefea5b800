"""Claims recovery-status job.

The canonical job stages a change set (claimants to close and to reopen)
before touching the master, merges it into a new master snapshot, and writes
one history row per change.  ``run_recovery`` publishes both outputs only
after every step succeeded.

Plan shape of the change set:
  claimant ⋉ (queue ⋉ enabled xref)                    -- semi joins, each claimant once; staged
  ⋈ left  txn_summary(transaction log ⋉ their keys)    -- one aggregation for latest + max
  → one pass that tags each row 'C' / 'R' / none       -- the base join is built once
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import functools
import os
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import thresholds as T
from ..functions.predicates import all_closed, any_open, any_open_v0, is_open_date, needs_reopen
from ..functions.scalar import date_int_literal, fn_error_text, fn_reopen_status
from ..operators.claims import (KEY3, apply_updates, assert_unique, latest_txn_or_null, queue_claimants,
                                to_history, txn_summary)
from ..operators.common import dense_surrogate, sparse_surrogate
from ..session import reliable_checkpoint, staged_table
from ..sources import bindings
from ..sources.bucketed import BucketedTable, Manifest
from ..sources.sinks import last_published, publish, published_history, published_runs, write_history

STAGE_COLUMNS = ["claimant_key", "claim_number", "claimant_number", "originating_business_unit",
                 "recovery_date_closed", "recovery_status", "valid_from_date", "update_type"]


#: The master's columns that decide a change.
DECIDING_COLUMNS = ["claimant_key", "claim_number", "claimant_number", "originating_business_unit", "salvage_status", "subrogation_status",
                    "tp_deductible_status", "recovery_date_closed", "recovery_status"]
UPDATED_COLUMNS = ["recovery_date_closed", "recovery_status"]


@dataclass
class ClaimTables:
    """The job's inputs; without a ``claimant`` the job takes the master it published last."""
    claimant: DataFrame | None
    stage: DataFrame
    queue: DataFrame
    xref: DataFrame


def _blank_to_null(df: DataFrame) -> DataFrame:
    """The source dialect stores '' as NULL; normalise string columns on scan."""
    return df.select(*[F.nullif(F.col(f.name), F.lit("")).alias(f.name)
                       if f.dataType.simpleString() == "string" else F.col(f.name)
                       for f in df.schema.fields])


def load_claims(spark: SparkSession, sf_dir: str, wide: bool = True) -> ClaimTables:
    """The four inputs of the job, '' normalised to NULL."""
    return ClaimTables(
        claimant=_blank_to_null(bindings.claimant(spark, sf_dir, wide=wide)),
        stage=_blank_to_null(bindings.claim_stage_consol(spark, sf_dir)),
        queue=_blank_to_null(bindings.wt_check_claim_iot(spark, sf_dir)),
        xref=_blank_to_null(bindings.business_unit_xref(spark, sf_dir)),
    )


def _run_int(run_date: _dt.date):
    return date_int_literal(run_date)


def change_candidates(t: ClaimTables, run_date: _dt.date, distinct: bool = True, where=None, latest: bool = True) -> DataFrame:
    """Queue claimants (those that ``where`` admits) with their transaction summary and both branch predicates.

    The claimants are staged, as both their keys and their rows are needed: the transaction log is reduced to the
    candidates' keys (semi join) before it is aggregated, so a daily queue moves its own transactions and not the whole log.  The staged
    table's size is known, so keys of a daily queue are broadcast; beyond the threshold, a log in buckets of key3 isn't moved either.
    ``latest=False`` leaves the closing transaction out (a reopening needs the newest date only)."""
    base = queue_claimants(t.queue, t.xref, t.claimant, distinct=distinct)
    base = staged_table(base if where is None else base.where(where), "recovery-candidates")
    j = base.join(txn_summary(t.stage, base.select(*KEY3).distinct(), latest=latest), KEY3, "left")
    reopen = any_open() & needs_reopen()
    tag = F.when(reopen, F.lit(T.UPDATE_REOPEN))
    if latest:
        close = all_closed() & is_open_date() & F.col("has_recovery_txn")
        tag = F.when(close, F.lit(T.UPDATE_CLOSE)).when(reopen, F.lit(T.UPDATE_REOPEN))
    return (j.withColumn("update_type", tag)
             .withColumn("valid_from_date",
                         F.coalesce(F.col("max_transaction_date"), _run_int(run_date)).cast("int")))


def changes(t: ClaimTables, run_date: _dt.date, kinds=(T.UPDATE_CLOSE, T.UPDATE_REOPEN)) -> DataFrame:
    """R3 (R1 / R2 with one kind): the staged change set, one row per claimant.

    Closing rows take the newest closing transaction's date and status 'C';
    reopening rows take date 0 and 'R' (was 'C') or 'O'.  Only the columns that decide are read of the master.
    """
    # What needs no transaction is decided first; only these claimants' transactions are read on.
    branch = {T.UPDATE_CLOSE: all_closed() & is_open_date(), T.UPDATE_REOPEN: any_open() & needs_reopen()}
    possible = functools.reduce(lambda a, b: a | b, (branch[k] for k in kinds))
    narrow = dataclasses.replace(t, claimant=t.claimant.select(*DECIDING_COLUMNS))
    closing = T.UPDATE_CLOSE in kinds
    cand = change_candidates(narrow, run_date, where=possible, latest=closing).where(F.col("update_type").isin(*kinds))
    is_close = F.col("update_type") == T.UPDATE_CLOSE
    closed_on = F.col("latest_txn_date") if closing else F.lit(None).cast("int")
    new_date = F.when(is_close, closed_on).otherwise(F.lit(T.OPEN_DATE)).cast("int")
    new_status = F.when(is_close, F.lit(T.STATUS_CLOSED)).otherwise(fn_reopen_status("recovery_status"))
    cand = cand.withColumn("recovery_date_closed", new_date).withColumn("recovery_status", new_status)
    return cand.select(*STAGE_COLUMNS)


def close_set(t: ClaimTables, run_date: _dt.date) -> DataFrame:
    """R1."""
    return changes(t, run_date, kinds=(T.UPDATE_CLOSE,))


def reopen_set(t: ClaimTables, run_date: _dt.date) -> DataFrame:
    """R2."""
    return changes(t, run_date, kinds=(T.UPDATE_REOPEN,))


def union_change_sets(t: ClaimTables, run_date: _dt.date) -> DataFrame:
    """The two staging inserts as one pass: each row is tagged close or reopen once, which equals
    their UNION ALL because the two predicates exclude each other."""
    return changes(t, run_date)


def apply_changes(claimant: DataFrame, change_set: DataFrame) -> DataFrame:
    """The new master snapshot (MERGE on claimant_key)."""
    return apply_updates(claimant, change_set, "claimant_key", UPDATED_COLUMNS)


def history(change_set: DataFrame, master: DataFrame, start_sequence: int = 0, dense: bool = True) -> DataFrame:
    """82-column history rows for the staged changes (J10 + F4 + P7).

    The sequence is assigned on the narrow change set (dense: ``start +
    row_number() over claimant_key`` without a single-partition window; sparse:
    unique increasing ids).  The numbered changes then meet the wide master
    on claimant_key; Spark broadcasts them when they are small, and the wide master is then not shuffled.
    """
    narrow = change_set.select("claimant_key", "recovery_date_closed", "recovery_status", "valid_from_date")
    numbered = (dense_surrogate(narrow, "claimant_key", start_sequence) if dense
                else sparse_surrogate(narrow, start_sequence))
    return to_history(history_rows(numbered, master))


def history_rows(change_set: DataFrame, claimant: DataFrame) -> DataFrame:
    """Change set ⋈ master on key — master columns, staged status / date / valid-from
    (and sequence number when the change set carries one)."""
    extra = [c for c in ("sequence_number",) if c in change_set.columns]
    staged = change_set.select("claimant_key", "valid_from_date", *extra,
                               F.col("recovery_status").alias("_st"), F.col("recovery_date_closed").alias("_dt"))
    master = claimant.drop("valid_from_date", *extra)
    j = master.join(staged, "claimant_key", "inner")
    return (j.withColumn("recovery_status", F.col("_st")).withColumn("recovery_date_closed", F.col("_dt"))
             .drop("_st", "_dt"))


def close_set_lenient(t: ClaimTables) -> DataFrame:
    """The first variant's close — no closing transaction needed; the date is then NULL."""
    base = queue_claimants(t.queue, t.xref, t.claimant, distinct=True)
    c = latest_txn_or_null(base.where(all_closed() & is_open_date()), t.stage)
    return c.select("claimant_key", F.col("latest_txn_date").cast("int").alias("recovery_date_closed"),
                    F.lit(T.STATUS_CLOSED).alias("recovery_status"))


def _post_update_base(t: ClaimTables, run_date: _dt.date, variant: str) -> DataFrame:
    """Queue claimants as the master looks after a variant's two updates."""
    narrow = dataclasses.replace(t, claimant=t.claimant.select(*DECIDING_COLUMNS))
    j = change_candidates(narrow, run_date, distinct=False)
    if variant == "v1":
        close = all_closed() & is_open_date() & F.col("has_recovery_txn")
        close_date = F.col("latest_txn_date")
        reopen = any_open() & needs_reopen()
    else:
        close = all_closed() & is_open_date()
        close_date = F.col("latest_txn_date")
        reopen = any_open_v0() & needs_reopen()
    # Both branches are decided on the pre-update values, then both columns change in one projection.
    j = j.withColumn("_close", F.coalesce(close, F.lit(False))).withColumn("_reopen", F.coalesce(reopen, F.lit(False)))
    new_date = (F.when(F.col("_close"), close_date).when(F.col("_reopen"), F.lit(T.OPEN_DATE))
                 .otherwise(F.col("recovery_date_closed")).cast("int"))
    new_status = (F.when(F.col("_close"), F.lit(T.STATUS_CLOSED))
                   .when(F.col("_reopen"), fn_reopen_status("recovery_status"))
                   .otherwise(F.col("recovery_status")))
    return (j.withColumns({"recovery_date_closed": new_date, "recovery_status": new_status})
             .drop("_close", "_reopen"))


def history_candidates_v1(t: ClaimTables, run_date: _dt.date) -> DataFrame:
    """The second variant's history predicate on the post-update master:
    (all closed AND EXISTS closing txn) OR (any open AND reopen guard)."""
    post = _post_update_base(t, run_date, "v1")
    pred = (all_closed() & F.col("has_recovery_txn")) | (any_open() & needs_reopen())
    return post.where(pred).select("claimant_key", "recovery_status", "recovery_date_closed", "valid_from_date")


def history_candidates_v0(t: ClaimTables, run_date: _dt.date) -> DataFrame:
    """The first variant's history predicate on the post-update master:
    (all closed AND open date) OR (any open AND reopen guard)."""
    post = _post_update_base(t, run_date, "v0")
    pred = (all_closed() & is_open_date()) | (any_open_v0() & needs_reopen())
    return post.where(pred).select("claimant_key", "recovery_status", "recovery_date_closed", "valid_from_date")


def run_summary(change_set: DataFrame, updated: int | None = None, history: int | None = None) -> DataFrame:
    """A2: rows closed / reopened / merged / history, one pass over the change set.  A run gives the numbers of
    rows its merge updated and its history received, as counted at the writes; without a run they are what the change set asks for."""
    agg = change_set.agg(F.count(F.when(F.col("update_type") == T.UPDATE_CLOSE, True)).alias("closed"),
                         F.count(F.when(F.col("update_type") == T.UPDATE_REOPEN, True)).alias("reopened"),
                         F.count(F.lit(1)).alias("staged"))
    step = lambda n: F.col("staged") if n is None else F.lit(n).cast("bigint")
    return (agg.select("closed", "reopened", step(updated).alias("updated"), step(history).alias("history"))
            .select(F.expr("stack(4, 'closed', closed, 'reopened', reopened, 'updated', updated, 'history', history) as (step, row_count)")))


class RecoveryError(RuntimeError):
    """The job's fatal error: code -20039 and its fixed message; the cause is kept."""

    def __init__(self, cause: BaseException):
        self.code = T.FATAL_ERROR_CODE
        self.detail = str(cause)[: T.ERROR_TEXT_LIMIT]
        super().__init__(f"ORA{self.code}: {T.FATAL_ERROR_MESSAGE} ({self.detail})")


def stage(df: DataFrame, reliable: bool = False) -> tuple[DataFrame, int]:
    """Materialise the change set once for the merge and the history; returns it with
    its exact row count.  ``reliable`` writes it to the shared checkpoint folder (nothing
    to release, survives executor loss); otherwise it is persisted (memory, spilling to
    disk) and the caller unpersists it."""
    if reliable:
        staged = reliable_checkpoint(df)
    else:
        staged = df.persist(StorageLevel.MEMORY_AND_DISK)
    return staged, staged.count()


#: Rows of the master in one bucket, at most: a task sorts a bucket's rows, wide ones, to write or to merge them.
BUCKET_ROWS = 1 << 18


def master_buckets(claimant: DataFrame, least: int = 8) -> int:
    """Buckets for a master as large as ``claimant``, so that a bucket stays as small however many rows there are."""
    rows, buckets = claimant.count(), least
    while rows > buckets * BUCKET_ROWS:
        buckets *= 2
    return buckets


def master_table(out_dir: str, parts: int = 8, buckets: int = 8) -> BucketedTable:
    """The published master: in buckets of ``claimant_key``, rewritten by parts.  The defaults suit small tables; ``master_buckets`` gives a
    large master's number, which its runs share through the publish log."""
    types = bindings.claimant_types()
    schema = StructType.fromDDL(", ".join(f"{c} {types[c]}" for c in bindings.CLAIMANT_COLUMNS))
    return BucketedTable(os.path.join(out_dir, "master"), schema, ("claimant_key",), parts, buckets)


def published_master(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The master of the last published run in one scan, whatever the number of runs; None when none was published."""
    last = last_published(spark, out_dir)
    return master_table(out_dir).read(spark, last.master) if last else None


def merge_master(spark: SparkSession, table: BucketedTable, manifest: Manifest, change_set: DataFrame, version: str) -> tuple[dict[int, list[str]], int]:
    """R4 on the published master: rewrite only the parts that hold a changed claimant, as a new version, beside the old one.

    Returns the new manifest and the number of updated rows, counted as they are written.  The master is joined in its buckets:
    none of its rows is moved."""
    touched = table.parts_of(change_set)
    if not touched:
        return dict(manifest), 0
    matched = Observation()
    with table.opened(spark, {p: manifest[p] for p in touched if p in manifest}) as name:
        old = spark.table(name).drop("part", "version")
        table.append(spark, apply_updates(old, change_set, "claimant_key", UPDATED_COLUMNS, matched), version, name, dealt=True)
    return {**manifest, **{p: [version] for p in touched if p in manifest}}, matched.get["rows"]


def run_recovery(spark: SparkSession, t: ClaimTables, run_date: _dt.date, out_dir: str, run_id: str | None = None,
                 parts: int = 8, buckets: int | None = None) -> dict:
    """The whole job.  Writes the master (whole when ``t`` brings one, else the changed parts of the published one),
    ``out_dir/history/run_id=<run_id>`` and ``out_dir/runs/<run_id>/summary``, and publishes by appending to ``out_dir/published`` last; any
    failure publishes nothing and raises :class:`RecoveryError`.  A published run id is refused.  The summary's ``updated`` and
    ``history`` are counted as the rows are written.  Without ``buckets`` a whole master gets as many as its rows ask for, and a merge goes on with those
    that the publish log names."""
    run_id = run_id or f"{run_date:%Y%m%d}-{uuid.uuid4().hex[:8]}"
    staged = None
    try:
        if run_id in published_runs(spark, out_dir):
            raise ValueError(f"run {run_id} is published")
        last = last_published(spark, out_dir)
        source = t.claimant if t.claimant is not None else published_master(spark, out_dir)
        if source is None:
            raise ValueError("no master is given and none is published")
        staged, n = stage(changes(dataclasses.replace(t, claimant=source), run_date))
        assert_unique(staged, "claimant_key")
        start = last.max_sequence if last else 0
        version = f"{run_id}-{uuid.uuid4().hex[:8]}"  # of this attempt: what a failed one has left is never read
        if t.claimant is None:
            buckets = last.buckets or buckets or 8
        elif buckets is None:
            buckets = master_buckets(t.claimant)
        table = master_table(out_dir, parts, buckets)
        if t.claimant is None:
            manifest, updated = merge_master(spark, table, last.master, staged, version)
        else:
            manifest, updated = write_master(spark, table, t.claimant, staged, version)
        written = Observation()
        write_history(history(staged, source, start_sequence=start).observe(written, F.count(F.lit(1)).alias("rows"), F.max("sequence_number").alias("high")),
                      out_dir, run_id)
        summary_path = os.path.join(out_dir, "runs", run_id, "summary")
        run_summary(staged, updated, written.get["rows"]).coalesce(1).write.mode("overwrite").parquet(summary_path)
        publish(out_dir, run_id, written.get["high"] or start, manifest, buckets)
        return {"run_id": run_id, "summary": summary_path, "changes": n}
    except Exception as exc:  # the job's WHEN OTHERS: nothing is published, one fixed error
        raise RecoveryError(exc) from exc
    finally:
        if staged is not None:
            staged.unpersist()


def write_master(spark: SparkSession, table: BucketedTable, claimant: DataFrame, change_set: DataFrame, version: str) -> tuple[dict[int, list[str]], int]:
    """The whole master after the changes as the first version of all its parts; the manifest and the number of updated rows."""
    matched = Observation()
    table.append(spark, apply_updates(claimant, change_set, "claimant_key", UPDATED_COLUMNS, matched), version)
    return {p: [version] for p in table.parts_of(claimant)}, matched.get["rows"]


def error_text(df: DataFrame) -> DataFrame:
    """F5 applied: the job's log line per claim, NULL parts read as ''."""
    return df.select("claimant_key", fn_error_text(F.lit("Problem with claim_number: "), F.col("claim_number"),
                                                   F.lit(" status "), F.col("recovery_status"))
                     .alias("error_text"))


__all__ = ["ClaimTables", "load_claims", "changes", "close_set", "reopen_set", "union_change_sets",
           "apply_changes", "history", "history_rows", "close_set_lenient", "history_candidates_v0",
           "history_candidates_v1", "run_summary", "run_recovery", "merge_master", "published_master", "RecoveryError",
           "stage", "published_history"]
