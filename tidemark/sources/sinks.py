"""Sinks: run history, the published master, report tables, and the publish step.

Nothing is written in place.  A run writes below its own run id or version and becomes visible only when
``publish`` appends its entry to the publish log, so a failed or retried run (lost executors, killed driver) leaves the previous
published state untouched and can simply be rerun.  A published run id is never written again.

The entry carries what readers need: the run's highest sequence number, the master's manifest and the number of its buckets.
"""

from __future__ import annotations

import datetime as _dt
import os
import time
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ENTRY = "published_at string, run_id string, max_sequence long, master array<struct<part: int, version: string>>, buckets int"


@dataclass(frozen=True)
class Published:
    """An entry of the publish log."""
    run_id: str
    published_at: str = ""
    max_sequence: int = 0
    master: dict[int, list[str]] = field(default_factory=dict)
    buckets: int | None = None


def _history(out_dir: str) -> str:
    return os.path.join(out_dir, "history")


def write_history(df: DataFrame, out_dir: str, run_id: str) -> str:
    """The run's history rows under ``history/run_id=<run_id>``, by month of ``valid_from_date``.

    A rerun of an unpublished run replaces its own rows; readers see them once the run is published.
    The rebalance hint lets AQE split a month with most of a run's rows over several tasks."""
    path = os.path.join(_history(out_dir), f"run_id={run_id}")
    (df.withColumn("valid_from_month", (F.col("valid_from_date") / 100).cast("int"))
       .hint("rebalance", "valid_from_month")
       .write.mode("overwrite").partitionBy("valid_from_month").parquet(path))
    return path


def publish_log(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The publish log as a table; None when nothing was published."""
    try:
        return spark.read.schema(_ENTRY).json(os.path.join(out_dir, "published"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def published_runs(spark: SparkSession, out_dir: str) -> list[str]:
    """Published run ids in the order of publishing (each once); none when nothing was published."""
    log = publish_log(spark, out_dir)
    if log is None:
        return []
    rows = log.groupBy("run_id").agg(F.max("published_at").alias("at")).orderBy("at").select("run_id").collect()
    return [r["run_id"] for r in rows]


def last_published(spark: SparkSession, out_dir: str) -> Published | None:
    """The newest entry of the publish log; ``max_sequence`` is the highest of all runs."""
    log = publish_log(spark, out_dir)
    top = log and log.agg(F.max_by(F.struct("published_at", "run_id", "master", "buckets"), "published_at").alias("last"), F.max("max_sequence").alias("high")).first()
    if not top or top["last"] is None:
        return None
    master: dict[int, list[str]] = {}
    for x in top["last"]["master"] or []:
        master.setdefault(x["part"], []).append(x["version"])
    return Published(top["last"]["run_id"], top["last"]["published_at"], top["high"] or 0, master, top["last"]["buckets"])


def published_history(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The history rows of published runs only, with their ``run_id``; None when they have none.

    One scan whatever the number of runs: ``run_id`` is a partition column, and folders of other runs are pruned by it."""
    runs = published_runs(spark, out_dir)
    if not runs:
        return None
    try:
        rows = spark.read.parquet(_history(out_dir))
    except AnalysisException as e:
        if e.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return None  # runs without changes: no folder holds a file
    return rows.withColumn("run_id", F.col("run_id").cast("string")).where(F.col("run_id").isin(runs))


def write_snapshot(df: DataFrame, out_dir: str, run_id: str) -> str:
    """Write the new master under ``runs/<run_id>/snapshot`` — never over the path being read."""
    path = os.path.join(out_dir, "runs", run_id, "snapshot")
    df.write.mode("overwrite").parquet(path)
    return path


def publish(out_dir: str, run_id: str, max_sequence: int = 0, master: dict[int, list[str]] | None = None, buckets: int | None = None) -> None:
    """Commit point: append one entry to the publish log ``out_dir/published``.

    Each entry is its own small folder written by one Spark job (visible only once
    committed), named by publish time, so readers see a run either fully published
    or not at all, and earlier entries are never rewritten."""
    spark = SparkSession.getActiveSession()
    stamp = f"{time.time_ns():020d}"
    parts = [(p, v) for p, versions in sorted((master or {}).items()) for v in versions]
    (spark.createDataFrame([(stamp, run_id, max_sequence, parts, buckets)], _ENTRY)
          .coalesce(1).write.mode("errorifexists").json(os.path.join(out_dir, "published", f"entry={stamp}")))


def current_run(spark: SparkSession, out_dir: str) -> str | None:
    """The most recently published run id, or None when nothing was published."""
    last = last_published(spark, out_dir)
    return last.run_id if last else None


def write_report(df: DataFrame, path: str, name: str, run_date: _dt.date) -> str:
    """Store one report table for one day; rerunning a day replaces only that day."""
    target = os.path.join(path, name)
    (df.withColumn("report_date", F.lit(run_date))
       .hint("rebalance")
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("report_date").parquet(target))
    return target
