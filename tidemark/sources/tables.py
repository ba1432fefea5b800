"""Column-pruned parquet scans of the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows dealt out by ``key`` to as many tasks as a shuffle has.  A narrow table is few splits however many rows it has; what follows
    may make many wide rows of one, or much work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; selecting the columns up front keeps ``ReadSchema`` narrow."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return df
