"""Daily rollups: one folder of reduced rows for each day, recomputed only for days with new or late rows.

A refresh takes the rows that have arrived since the last one, finds their days, recomputes just those days from the raw rows
(whose scan is pruned to them), and writes each as a new version.  The log then names the version of each day; readers take only the days that a
report asks for, so a report over 31 days reads 31 small folders however long the history is.  Versions are never written in place,
so a refresh that fails leaves the last state; a refresh that runs again replaces what it had recomputed.
"""

from __future__ import annotations

import datetime as _dt
import os
import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "stamp string, day date, version string"


class DailyRollup:
    """``build(days)`` gives the reduced rows of the given days, with a column ``report_date``."""

    def __init__(self, root: str, build: Callable[[list[_dt.date]], DataFrame]):
        self.root, self.build = root, build

    def refresh(self, spark: SparkSession, arrived: DataFrame, ts: str = "ts") -> list[_dt.date]:
        """Recompute the days of the ``arrived`` rows; returns them (a row a day reaches the driver)."""
        days = sorted(r["day"] for r in arrived.select(F.to_date(ts).alias("day")).where(F.col("day").isNotNull()).distinct().collect())
        if not days:
            return []
        version = uuid.uuid4().hex
        rows = self.build(days).where(F.col("report_date").isin(days))
        (rows.withColumns({"day": F.col("report_date"), "version": F.lit(version)}).hint("rebalance", "day")
             .write.partitionBy("day", "version").mode("append").parquet(os.path.join(self.root, "rows")))
        stamp = f"{time.time_ns():020d}"
        (spark.createDataFrame([(stamp, d, version) for d in days], _LOG).coalesce(1)
              .write.mode("errorifexists").json(os.path.join(self.root, "log", f"entry={stamp}")))
        return days

    def _current(self, spark: SparkSession, start: _dt.date, end: _dt.date) -> list[tuple[_dt.date, str]]:
        try:
            log = spark.read.schema(_LOG).json(os.path.join(self.root, "log"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        rows = (log.where(F.col("day").between(start, end)).groupBy("day").agg(F.max_by("version", "stamp").alias("version")).collect())
        return sorted((r["day"], r["version"]) for r in rows)

    def read(self, spark: SparkSession, start: _dt.date, end: _dt.date) -> DataFrame:
        """The rows of the days from ``start`` to ``end``: a scan of those days' current folders only."""
        schema = self.build([start]).schema
        paths = [os.path.join(self.root, "rows", f"day={d}", f"version={v}") for d, v in self._current(spark, start, end)]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
