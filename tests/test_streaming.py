"""Streaming feed counts: restart from the checkpoint is idempotent, new files add to the state."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.sources.tables import read_table
from tidemark.streaming.feeds import read_feed_counts, run_feed_counts


def _expected(df):
    return {(str(r["d"]), r["source"]): r["n"] for r in
            df.groupBy(F.to_date("ts").alias("d"), F.col("event_type").alias("source"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}


def test_feed_counts_restart_and_new_files(spark):
    base = tempfile.mkdtemp(prefix="tidemark-test-stream-")
    feed = os.path.join(base, "feed")
    events = read_table(spark, SF_SMALL, "events")
    first = events.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    second = events.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    first.coalesce(1).write.parquet(os.path.join(feed, "part1"))
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")

    def counts():
        return {(str(r["report_date"]), r["source"]): r["records"] for r in read_feed_counts(spark, out).collect()}

    glob = "*.parquet"
    run_feed_counts(spark, os.path.join(feed, "part1"), out, ckpt, glob)
    assert counts() == _expected(first)
    # Restart with nothing new: the checkpoint knows the file, nothing changes.
    run_feed_counts(spark, os.path.join(feed, "part1"), out, ckpt, glob)
    assert counts() == _expected(first)

    # A second, separate stream over the full feed directory sees both files.
    second.coalesce(1).write.parquet(os.path.join(feed, "part2"))
    out2, ckpt2 = os.path.join(base, "out2"), os.path.join(base, "ckpt2")
    run_feed_counts(spark, feed, out2, ckpt2, glob)
    got = {(str(r["report_date"]), r["source"]): r["records"] for r in read_feed_counts(spark, out2).collect()}
    assert got == _expected(events)


def test_many_files_newest_first_lose_nothing(spark):
    base = tempfile.mkdtemp(prefix="tidemark-test-stream-")
    events = read_table(spark, SF_SMALL, "events").withColumn("file", F.crc32(F.col("event_id").cast("string")) % 210)
    days = [r["d"] for r in events.select(F.to_date("ts").alias("d")).distinct().orderBy(F.desc("d")).collect()]
    for i, day in enumerate(days):  # the newest day is written first, so it has the oldest files
        (events.where(F.to_date("ts") == F.lit(day)).repartition(7, "file").drop("file")
         .write.parquet(os.path.join(base, "feed", f"n{i:03d}")))
    n_files = sum(f.endswith(".parquet") for _, _, names in os.walk(os.path.join(base, "feed")) for f in names)
    assert n_files > 200
    out = os.path.join(base, "out")
    run_feed_counts(spark, os.path.join(base, "feed"), out, os.path.join(base, "ckpt"), "*.parquet", files_per_batch=64)
    got = {(str(r["report_date"]), r["source"]): r["records"] for r in read_feed_counts(spark, out).collect()}
    assert got == _expected(events)
