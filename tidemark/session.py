"""Session construction and cluster-shared locations."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go when nothing refers to their data any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app_name: str = "tidemark",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster, use the cluster's
    session and size ``spark.sql.shuffle.partitions`` to the data."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is made only on a local master (tests), where driver and executors
    share it; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for job outputs, next to the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = os.path.join(base, "tidemark-work", name)
    return path


def reliable_checkpoint(df):
    """Write ``df`` to the shared checkpoint folder (one pass) and return the checkpointed
    DataFrame: its lineage is cut and it survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged_table(df, name: str):
    """Write ``df`` as Parquet next to the shared checkpoint folder and read it back: lineage is cut as by a checkpoint, and
    Spark knows the table's size, so that it can broadcast a small one instead of shuffling what it meets."""
    return _staged(df, name)[0]


def _staged(df, name: str):
    import uuid

    spark = df.sparkSession
    path = work_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of a staged table that nothing unwritten reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Whether a job's shuffle files go when it ends; otherwise they lie until the driver's JVM finds that nothing refers to them.
DROPS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Jobs inside delete their shuffle files when they end.  For jobs that write a table, as their plans aren't run again."""
    old = spark.conf.get(DROPS_SHUFFLES, None)
    spark.conf.set(DROPS_SHUFFLES, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(DROPS_SHUFFLES)
        else:
            spark.conf.set(DROPS_SHUFFLES, old)


class StagedTables:
    """Staged tables of one task, each deleted once what was made of it is written; their jobs' shuffle files go at once."""

    def __init__(self):
        self.paths = {}

    def __call__(self, df, name: str):
        with shuffles_dropped(df.sparkSession):
            out, path = _staged(df, name)
        self.paths[id(out)] = out, path
        return out

    def discard(self, *tables) -> None:
        for table in tables:
            _, path = self.paths.pop(id(table))
            delete_path(table.sparkSession, path)


class StagedRounds:
    """The newest table of a loop whose rounds join it with itself, staged as Parquet; the round before is deleted.

    A checkpointed table keeps Spark's estimate of its size, and a join's estimate is the product of its sides.  In such a loop
    the estimate is squared each round: after twenty rounds it is a number of millions of digits, and planning takes longer than the work.  A staged
    table has the size of its files."""

    def __init__(self, name: str):
        self.name, self.path = name, None

    def next(self, df):
        spark, old = df.sparkSession, self.path
        out, self.path = _staged(df, self.name)
        if old:
            delete_path(spark, old)
        return out
