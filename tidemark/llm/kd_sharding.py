"""Sharding (3): K-d tree partitioning on metadata, DataFrame operations only.

Each node of the tree stands for a number of shards.  It is cut along the widest metadata
dimension (by the share of the dimension's whole extent that the node spans) at the
weighted median: the cut at which the bytes on each side are in proportion to the shards
on each side.  Recursion ends at one shard, when leaves have reached the target bytes.

The weighted medians are exact up to ``tolerance`` of a shard's bytes: a histogram of
4,096 bins for each node finds the bin holding the median, and the next pass divides only
that bin.  Ties on the dimension are cut on a hash of the row, and rows alike in that too on
their row number, so neither a hot value nor repeated rows unbalance the shards.

Defined results: a null dimension sorts first; a null text has size 8 and checksum 0; an
empty table gives an empty result; other columns are ignored.  The driver holds the tree only (at
most one row for each shard).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import boxed, stage

BIN_BITS = 12


def ordered_key(docs: DataFrame, column: str) -> Column:
    """An order-preserving, non-negative 63-bit key; strings by their first seven bytes, null lowest.

    Values that share a key (integers beyond 62 bits, strings alike in seven bytes) are ties, which the cut may part.
    """
    kind, c = dict(docs.dtypes)[column], docs[column]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        key = F.least(F.greatest(c.cast("long"), F.lit(-2**62)), F.lit(2**62 - 1)) + F.lit(2**62)
    elif kind in ("float", "double") or kind.startswith("decimal"):
        key = F.least(F.greatest((F.signum(c.cast("double")) * F.log1p(F.abs(c.cast("double"))) * 1e15).cast("long"), F.lit(-2**61)), F.lit(2**61)) + F.lit(2**62)
    elif kind in ("date", "timestamp", "timestamp_ntz"):
        key = F.unix_micros(c.cast("timestamp")) + F.lit(2**62)
    else:
        key = F.conv(F.rpad(F.hex(F.substring(c.cast("string").cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")
    return F.coalesce(key, F.lit(0).cast("long"))


def numbers(near: DataFrame, rows: list[tuple], ddl: str) -> DataFrame:
    """A small table of integers as literals (no RDD)."""
    fields = [f.split() for f in ddl.split(", ")]
    values = ", ".join("(" + ", ".join(str(v) for v in r) + ")" for r in rows)
    cast = ", ".join(f"cast({n} as {t}) as {n}" for n, t in fields)
    return near.sparkSession.sql(f"select {cast} from values {values} as t({', '.join(n for n, _ in fields)})")


def _cuts(rows: DataFrame, nodes: list[dict], tolerance: float) -> list[dict]:
    """For each node the cut: rows up to (e0, e1, upto) in the order (dimension, tie, rid) go left."""
    open_nodes = [n | {"level": 0, "e0": 0, "e1": 0, "base": 0, "lo": n["lo"], "hi": n["hi"]} for n in nodes]
    done: list[dict] = []
    while open_nodes:
        for n in open_nodes:
            n["shift"] = max(0, (n["hi"] - n["lo"]).bit_length() - BIN_BITS)
        find = numbers(rows, [(n["node"], n["dim"], n["level"], n["e0"], n["e1"], n["lo"], n["hi"], n["shift"], n["target"] - n["base"]) for n in open_nodes],
                       "node long, dim int, level int, e0 long, e1 long, lo long, hi long, shift int, need long")
        at = (rows.join(F.broadcast(find), "node")
              .withColumn("d", F.get("dims", "dim"))
              .withColumn("key", F.when(F.col("level") == 0, F.col("d"))
                          .when((F.col("level") == 1) & (F.col("d") == F.col("e0")), F.col("tie"))
                          .when((F.col("level") == 2) & (F.col("d") == F.col("e0")) & (F.col("tie") == F.col("e1")), F.col("rid")))
              .where("key between lo and hi")
              .groupBy("node", F.expr("shiftright(key - lo, shift)").alias("bin"), "need").agg(F.sum("size").alias("w"), F.min("key").alias("kmin"), F.max("key").alias("kmax")))
        by = Window.partitionBy("node").orderBy("bin")
        found = {r["node"]: r for r in
                 (at.withColumn("upto", F.sum("w").over(by.rowsBetween(Window.unboundedPreceding, 0)))
                  .where("upto >= need").withColumn("rn", F.row_number().over(by)).where("rn = 1").collect())}
        still = []
        for n in open_nodes:
            r = found[n["node"]]
            below, weight = r["upto"] - r["w"], r["w"]
            need, level = n["target"] - n["base"], n["level"]
            if weight <= tolerance or (level == 2 and r["kmin"] == r["kmax"]):
                cut = r["kmax"] if need - below >= weight / 2 else r["kmin"] - 1
                done.append({"node": n["node"], "dim": n["dim"], "level": level, "e0": n["e0"], "e1": n["e1"], "upto": cut})
            elif r["kmin"] == r["kmax"]:  # one value holds the median: go on with the next key among its rows
                n |= {"level": level + 1, "base": n["base"] + below, ("e0", "e1")[level]: r["kmin"], "lo": 0, "hi": 2**63 - 1}
                still.append(n)
            else:
                n |= {"base": n["base"] + below, "lo": r["kmin"], "hi": r["kmax"]}
                still.append(n)
        open_nodes = still
    return done


def _descend(rows: DataFrame, cuts: list[dict]) -> DataFrame:
    tree = numbers(rows, [(c["node"], c["dim"], c["level"], c["e0"], c["e1"], c["upto"]) for c in cuts], "node long, dim int, level int, e0 long, e1 long, upto long")
    d = F.get("dims", "dim")
    left = (F.when(F.col("level") == 0, d <= F.col("upto"))
            .when(F.col("level") == 1, (d < F.col("e0")) | ((d == F.col("e0")) & (F.col("tie") <= F.col("upto"))))
            .otherwise((d < F.col("e0")) | ((d == F.col("e0")) & ((F.col("tie") < F.col("e1")) | ((F.col("tie") == F.col("e1")) & (F.col("rid") <= F.col("upto")))))))
    return (rows.join(F.broadcast(tree), "node", "left")
            .withColumn("node", F.when(F.col("dim").isNull(), F.col("node")).otherwise(2 * F.col("node") + F.when(left, 0).otherwise(1)))
            .select(*rows.columns))


def assign(rows: DataFrame, n_dims: int, n_shards: int | None = None, target_bytes: int | None = None,
           tolerance: float = 0.0005) -> DataFrame:
    """Adds ``shard`` (0 to n - 1) to staged slim rows with ``rid, size, tie`` and ``dims`` (array of keys)."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    shards = n_shards or max(1, math.ceil(total / target_bytes))
    if not total:
        return rows.withColumn("shard", F.lit(0))
    rows = stage(rows.withColumn("node", F.lit(1).cast("long")), "shard-nodes")
    inner = [(1, 0, shards)]  # (node, first shard, shards)
    leaves: list[tuple[int, int]] = []
    extent: list[int] | None = None
    while inner:
        leaves += [(node, first) for node, first, k in inner if k == 1]
        inner = [x for x in inner if x[2] > 1]
        if not inner:
            break
        want = numbers(rows, [(x[0],) for x in inner], "node long")
        stats = {r["node"]: r for r in rows.join(F.broadcast(want), "node").groupBy("node")
                 .agg(F.sum("size").alias("w"), *[f(F.get("dims", F.lit(i))).alias(f"{f.__name__}{i}") for i in range(n_dims) for f in (F.min, F.max)]).collect()}
        spans = {node: [r[f"max{i}"] - r[f"min{i}"] for i in range(n_dims)] for node, r in stats.items()}
        extent = extent or spans[1]
        asked = []
        for node, _, k in inner:
            if node in stats:
                widest = max(range(n_dims), key=lambda i: (spans[node][i] / extent[i] if extent[i] else 0, -i))
                asked.append({"node": node, "dim": widest, "target": stats[node]["w"] * (k // 2) // k, "lo": stats[node][f"min{widest}"], "hi": stats[node][f"max{widest}"]})
        # The slim rows are written level by level: every pass then has the same short plan, however deep the tree.
        rows = stage(_descend(rows, _cuts(rows, asked, tolerance * total / shards)), "shard-nodes") if asked else rows
        inner = [y for node, first, k in inner for y in ((2 * node, first, k // 2), (2 * node + 1, first + k // 2, k - k // 2))]
    names = numbers(rows, leaves, "node long, shard int")
    return rows.join(F.broadcast(names), "node").drop("node")


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard: rows are numbered within the write tasks of the staged table, the tasks' counts are added up."""
    rows = rows.withColumn("chunk", F.shiftright("rid", 33))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
              .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    own = Window.partitionBy("shard", "chunk").orderBy("rid")
    return (rows.withColumn("in_chunk", F.row_number().over(own) - 1).join(starts, ["shard", "chunk"])
            .withColumn("slot", (F.col("start") + F.col("in_chunk")).cast("long")).drop("chunk", "start", "in_chunk"))


def measures(docs: DataFrame, text: str, doc_id: str, dims: tuple[str, ...]) -> list[Column]:
    """What the tree needs of each row."""
    return [(F.coalesce(F.octet_length(docs[text]), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(docs[text].cast("binary")), F.lit(0).cast("long")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(docs[doc_id], docs[text]), 1).alias("tie"),
            F.array(*[ordered_key(docs, c) for c in dims]).alias("dims")]


def kd_shards(docs: DataFrame, dims: tuple[str, ...] = ("source", "lang", "n_chars", "doc_id"), *, n_shards: int | None = 24,
              target_bytes: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row."""
    rows = stage(docs.select(F.monotonically_increasing_id().alias("rid"), docs[doc_id].alias("doc_id"), *measures(docs, text, doc_id, dims)), "shard-rows")
    out = numbered(assign(rows, len(dims), n_shards, target_bytes))
    return out.select("doc_id", "size", "text_crc32", "shard", "slot")


def sharded_documents(docs: DataFrame, dims: tuple[str, ...] = ("source", "lang", "n_chars", "doc_id"), *, n_shards: int | None = 24,
                      target_bytes: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with ``size, text_crc32, law, shard, slot`` (which replace columns of these names)."""
    box = stage(boxed(docs, *measures(docs, text, doc_id, dims)), "shard-docs")
    out = numbered(assign(box.select("rid", "size", "tie", "dims"), len(dims), n_shards, target_bytes)).select("rid", "shard", "slot")
    own = [c for c in docs.columns if c not in ("size", "text_crc32", "law", "shard", "slot")]
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return box.join(out, "rid").select(*[F.col(names[c]).alias(c) for c in own], "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")
