"""Tables kept in hash buckets, so that joins and groupings on their key move no row of them.

A :class:`BucketedTable` is a folder of Parquet files below ``root/part=<p>/version=<v>/``: ``part`` is a hash of the key and the unit
that a merge rewrites; inside, files are written in Spark's hash buckets of the key.  A version folder is never changed once written.
Which version of each part counts is a *manifest* (part -> versions) that the publish log keeps; it has at most a few entries for each
part, however many runs there were.  ``opened`` registers the manifest's folders as a Spark table with ``CLUSTERED BY``: Spark then knows
that the table is partitioned by its key, and plans no exchange of it below a join or grouping on the key.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Manifest = Mapping[int, Sequence[str]]


@dataclass(frozen=True)
class BucketedTable:
    root: str
    schema: StructType
    keys: tuple[str, ...]
    parts: int = 8
    buckets: int = 8

    def part(self) -> Column:
        # another hash than the buckets', which would leave a part with few of them
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def parts_of(self, rows: DataFrame) -> list[int]:
        """The parts that hold the keys of ``rows``: at most ``parts`` numbers reach the driver."""
        return sorted(r["part"] for r in rows.select(self.part().alias("part")).distinct().collect())

    @contextlib.contextmanager
    def opened(self, spark: SparkSession, manifest: Manifest) -> Iterator[str]:
        """The name of a Spark table over the manifest's folders; it is dropped (not its files) on leaving."""
        name = f"tidemark_{uuid.uuid4().hex}"
        quoted = lambda c: "`" + c.replace("`", "``") + "`"
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in self.schema.fields)
        keys = ", ".join(map(quoted, self.keys))
        spark.sql(f"CREATE TABLE {name} ({columns}, part INT, version STRING) USING parquet PARTITIONED BY (part, version) "
                  f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.root}'")
        try:
            folders = [f"PARTITION (part={p}, version='{v}')" for p, versions in sorted(manifest.items()) for v in versions]
            for at in range(0, len(folders), 500):
                spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(folders[at:at + 500])}")
            yield name
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    def append(self, spark: SparkSession, rows: DataFrame, version: str, table: str | None = None, dealt: bool = False) -> None:
        """Write ``rows`` as a new version of their parts.  ``dealt`` says that rows of one bucket are in one task already, as after a
        join with the opened table; otherwise they are dealt out so that a task writes whole buckets."""
        rows = rows if dealt else rows.repartition(self.buckets, *self.keys)
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields], self.part().alias("part"), F.lit(version).alias("version"))
        if table is None:
            with self.opened(spark, {}) as table:
                rows.write.insertInto(table)
        else:
            rows.write.insertInto(table)

    def read(self, spark: SparkSession, manifest: Manifest) -> DataFrame:
        """The manifest's rows as one scan of its folders (without a Spark table, so the frame can outlive it)."""
        paths = [f"{self.root}/part={p}/version={v}" for p, versions in sorted(manifest.items()) for v in versions]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)
