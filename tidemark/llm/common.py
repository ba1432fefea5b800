"""Helpers shared by the training-data operators.

Scratch tables are Parquet folders below the session's ``spark.checkpoint.dir``:
they cut lineage, survive the loss of an executor, and are read back with column
pruning.  ``release`` deletes those of steps that are over.
"""

from __future__ import annotations

import sys
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

#: ASCII white space; ``bytes.split()`` splits at exactly these bytes, so it yields the words ``[^\x20\x09-\x0D]+``.
WHITE = b" \t\n\r\x0b\x0c"
#: Scratch tables written so far, in order.
STAGED: list[str] = []
#: The folder behind each frame that ``stage`` returned.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def ship(module: str) -> None:
    """Send the module's functions to the executors with each job, so that they need no installed copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``keep`` holds it back from ``release``."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not keep:
        STAGED.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the tables behind frames from ``stage`` that nothing unwritten reads any more: what was made of them is written itself."""
    for df in frames:
        release(df.sparkSession, [_FOLDERS.pop(df)])


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables (of ``STAGED``) whose results are written, and empty the list."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def boxed(docs: DataFrame, *extra: Column) -> DataFrame:
    """The columns of ``docs`` under neutral names ``c0, c1, ...`` (no clash with scratch columns), ``rid`` and ``extra``.

    ``rid`` numbers the rows; it is only stable once the frame is staged.
    """
    return docs.select(*[docs[_quoted(c)].alias(f"c{i}") for i, c in enumerate(docs.columns)],
                       F.monotonically_increasing_id().alias("rid"), *extra)


def unboxed(columns: list[str]) -> list[Column]:
    return [F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_bytes(text: str | Column) -> Column:
    """UTF-8 bytes of a text; null counts as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def mapped(df: DataFrame, fn: Callable[[dict[str, list]], dict], schema: str, rows: int = 512) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` rows: ``fn`` gets lists and returns lists or numpy arrays by column name."""
    target = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def grouped(df: DataFrame, keys: list[str], fn: Callable[[dict[str, list]], dict[str, list] | None], schema: str,
            order: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Shuffle by ``keys``, sort, and call ``fn`` once for each key with its rows as lists.

    Streams through a partition and holds one group at a time, so callers keep groups bounded.
    """
    target = _arrow_schema(df.sparkSession, schema)
    names = columns or df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {n: [] for n in names}
        last: tuple | None = None
        out: dict[str, list] = {f.name: [] for f in target}

        def close() -> None:
            got = fn(held) if last is not None else None
            for k in out if got else ():
                out[k].extend(got[k])

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)
            for v in out.values():
                v.clear()
            return made

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                cols = {n: part.column(part.schema.get_field_index(n)).to_pylist() for n in names}
                ks = list(zip(*(cols[k] for k in keys), strict=True))
                start = 0
                for i in range(len(ks) + 1):
                    if i == len(ks) or ks[i] != (ks[start] if start < i else last):
                        for n in names:
                            held[n].extend(cols[n][start:i])
                        if i < len(ks):
                            close()
                            for v in held.values():
                                v.clear()
                            last, start = ks[i], i
                if len(next(iter(out.values()))) >= 4096:
                    yield flush()
        close()
        yield flush()

    return (df.select(*names).repartition(*keys).sortWithinPartitions(*keys, *(order or []))
            .mapInArrow(run, schema))


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def hash64(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data)


class WordHashes(dict):
    """word -> 64-bit hash, remembered for a bounded number of words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (two rounds of xor-shift and multiplication)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive items; empty when there are fewer."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + m]
    return mix64(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def choose_bands(similarity: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows in a band for which a pair of the given similarity meets in a
    band with probability ``recall`` or more, within ``max_hashes`` hash functions."""
    best = (0, 0)
    for rows in range(1, max_hashes + 1):
        p = similarity ** rows
        bands = 1 if p >= 1 else int(np.ceil(np.log(1 - recall) / np.log1p(-p)))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if not best[0]:
        raise ValueError("the recall needs more hash functions than max_hashes")
    return best
