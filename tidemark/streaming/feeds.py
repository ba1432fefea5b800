"""Source-feed counts as a Structured Streaming job (the streaming form of S2).

Feed files are read incrementally; each event is one received record of its source.  A
micro-batch is summed to one row per (day, source) and written by ``foreachBatch`` into its
own ``batch_id=<n>`` folder.  Partial counts are additive, so no state and no watermark are
needed: nothing is ever late, whatever the number, size or order of the files.  A retried
micro-batch overwrites its own folder, so the sink is idempotent and the job restarts from
its checkpoint after a failure.  Readers add the batches up.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEED_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
PARTIAL_SCHEMA = "report_date date, source string, records long, last_refresh timestamp_ntz"


def feed_stream(spark: SparkSession, feed_dir: str, file_glob: str = "events*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """The feed's files; ``files_per_batch`` sets the size of a micro-batch and never the result."""
    reader = (spark.readStream.schema(FEED_SCHEMA).option("pathGlobFilter", file_glob)
                   .option("recursiveFileLookup", "true"))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(feed_dir)


def daily_counts(events: DataFrame) -> DataFrame:
    """Records and last arrival per (day, source); the zone-less arrival time gives the day."""
    return (events.groupBy(F.to_date("ts").alias("report_date"), F.col("event_type").alias("source"))
                  .agg(F.count(F.lit(1)).alias("records"), F.max("ts").alias("last_refresh")))


def run_feed_counts(spark: SparkSession, feed_dir: str, out_dir: str, checkpoint: str,
                    file_glob: str = "events*.parquet", files_per_batch: int | None = None) -> None:
    """Process every available feed file, then stop (``availableNow``)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        daily_counts(batch).write.mode("overwrite").parquet(os.path.join(out_dir, f"batch_id={batch_id}"))

    q = (feed_stream(spark, feed_dir, file_glob, files_per_batch).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_feed_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The counts of all batches so far, one row per (day, source)."""
    return (spark.read.schema(PARTIAL_SCHEMA).parquet(out_dir).groupBy("report_date", "source")
                 .agg(F.sum("records").alias("records"), F.max("last_refresh").alias("last_refresh")))
