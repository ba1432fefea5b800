"""Daily rollups: late rows, pruned recomputation and reads."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from tidemark.plans import reports as Rp
from tidemark.sources import bindings as B
from tidemark.sources.rollup import DailyRollup

DAY = dt.date(2024, 3, 1)


def _events(spark, days, n=40):
    rows = [(i * 100 + k, dt.datetime.combine(DAY + dt.timedelta(days=i), dt.time(k % 24)), k % 7, ["view", "click"][k % 2]) for i in days for k in range(n + i)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string")


def _rows(df):
    return sorted(map(str, df.select("report_date", "section", "product", "metric", "value").collect()))


def test_rollup_equals_raw_after_late_rows(spark):
    events = _events(spark, range(60))
    late = F.col("event_id").isin(305, 4107, 4108, 5903)
    root = tempfile.mkdtemp(prefix="tidemark-test-rollup-")
    asked = []

    def build(raw):
        def rows(days):
            asked.append(list(days))
            return B.daily_counts(raw.where(B.on_days("ts", days)))
        return rows

    first = DailyRollup(root, build(events.where(~late)))
    assert first.read(spark, DAY, DAY).count() == 0 and first.refresh(spark, events.where("false")) == []
    assert len(first.refresh(spark, events.where(~late))) == 60
    rollup = DailyRollup(root, build(events))
    asked.clear()
    assert rollup.refresh(spark, events.where(late)) == [DAY + dt.timedelta(days=i) for i in (3, 41, 59)] == asked[0]
    run = DAY + dt.timedelta(days=59)
    window = rollup.read(spark, run - dt.timedelta(days=30), run)
    raw = B.daily_counts(events).where(F.col("report_date").between(run - dt.timedelta(days=30), run))
    assert _rows(window) == _rows(raw)
    per_series = window.groupBy("product", "metric").count().agg(F.max("count")).first()[0]
    assert per_series <= 31 and len(window.inputFiles()) <= 31 * 8
    assert all(f"day={run - dt.timedelta(days=31)}" not in f for f in window.inputFiles())
    assert sorted(map(str, Rp.kpi_comparison(window, run).collect())) == sorted(map(str, Rp.kpi_comparison(raw, run).collect()))
    rollup.refresh(spark, events.where(late))  # again: nothing counts twice
    assert _rows(rollup.read(spark, DAY, run)) == _rows(B.daily_counts(events))


def test_days_become_few_pushed_ranges(spark):
    days = [DAY + dt.timedelta(days=i) for i in (0, 1, 2, 5, 9, 10)]
    events = _events(spark, range(12), n=2)
    got = {r["d"] for r in events.where(B.on_days("ts", days)).select(F.to_date("ts").alias("d")).collect()}
    assert got == set(days) and events.where(B.on_days("ts", [])).count() == 0
