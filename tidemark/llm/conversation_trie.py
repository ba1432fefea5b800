"""Conversation prefix trie (12): block digests first, turn boundaries only where siblings diverge.

A node is a distinct sequence of the first d turns (role, text) of a conversation; its members are the conversations that
start with it, and it is named by its smallest member and its depth.  Turns are digested (128 bits of SHA-256 over role and
text) and dealt into blocks of ``BLOCK`` turns.  A block's prefix key is the exclusive-or of two 64-bit hashes of the
blocks so far, each hashed with its place.

1. Conversations are grouped by successive block keys.  A group whose members all go on with the same block has the
   block's turns as a plain chain of nodes: nothing is compared there.
2. Only in blocks where members of a group go on differently (or end) are turns taken apart: members are grouped by
   the digest of the block's first one, two, ... turns.

Subtree figures need no walk over the tree.  Every leaf, and every node's saving, is booked on the conversation that names
the node; a node's leaves are then a sum over its members.  For savings the same sum also holds what the naming
conversation saves above the node, which a running sum along its own chain takes away.

Defined results: rows without a conversation id are left out; null role or text is empty; turns are ordered by turn number,
null first, equal numbers by their digest; repeated rows are turns of their own; without conversations the
result is empty; other columns are not read, whatever their names.

Plan: only ids, digests and lengths are shuffled, never texts.  Places in a conversation come from one range sort with an offset
for each partition, and running values go over spans of ``SPAN`` rows and then over spans, so that a conversation or a group of
copies with a third of all rows is spread over tasks.  Groupings are partially aggregated before their shuffle.  The list
of ids that end at a node is packed by range-sorted tasks and hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stage

ship(__name__)

BLOCK = 4
SPAN = 1024
#: Characters of packed ids in one row.
CHUNK = 1 << 16
_KEY = ["k", "p1", "p2", "r", "y1", "y2"]


# --------------------------------------------------------------------------- turns in order

def _ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``rank``, its row numbers in the given order from 0: a range sort, and an offset for each partition."""
    place = F.monotonically_increasing_id()  # partition number << 33, plus the place in the partition
    ranged = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", place), name)
    ranged = ranged.withColumn("part", F.shiftright("place", 33))
    offsets, at = [], 0
    for r in sorted(ranged.groupBy("part").agg(F.count("*").alias("n")).collect(), key=lambda r: r["part"]):
        offsets.append((r["part"], at - (r["part"] << 33)))
        at += r["n"]
    base = df.sparkSession.createDataFrame(offsets, "part long, base long")
    return ranged.join(F.broadcast(base), "part").withColumn("rank", F.col("place") + F.col("base")).drop("part", "place", "base")


def ordered_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, digest, chars) of each turn, ``pos`` numbering the turns of a conversation from 0 in their order."""
    said, body = F.coalesce(rows[role], F.lit("")), F.coalesce(rows[text], F.lit(""))
    whole = F.concat_ws(" ", F.length(said).cast("string"), said, body)
    slim = rows.where(rows[conv].isNotNull()).select(
        rows[conv].cast("long").alias("conv"), rows[turn].alias("turn"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("digest"), F.length(body).cast("long").alias("chars"))
    ranked = _ranked(slim, [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("digest").asc()], "trie-order")
    first = ranked.groupBy("conv").agg(F.min("rank").alias("first"))
    return ranked.join(first, "conv").select("conv", (F.col("rank") - F.col("first")).alias("pos"), "digest", "chars")


def shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The fixture of the registered query: (conversations, turns) in which conversation c starts with the first
    h = crc32(decimal c) % 6 turns of conversation c - c % 100, and goes on with its own turns after its first h."""
    turns = stage(turns, "trie-turns")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    donors = turns.where((F.col("conv") % 100 == 0) & (F.col("pos") < 5))
    given = donors.groupBy("conv").agg(F.count("*").alias("given")).withColumnRenamed("conv", "donor")
    convs = (turns.select("conv").distinct().withColumn("h", h).withColumn("donor", F.col("conv") - F.col("conv") % 100)
             .join(given, "donor", "left").withColumn("given", F.least("h", F.coalesce("given", F.lit(0).cast("long")))))
    convs = stage(convs, "trie-convs")
    head = (convs.select("conv", "donor", "h").join(donors.withColumnRenamed("conv", "donor"), "donor").where(F.col("pos") < F.col("h"))
            .select("conv", "pos", "digest", "chars"))
    own = (turns.join(convs.select("conv", "h", "given"), "conv").where(F.col("pos") >= F.col("h"))
           .select("conv", (F.col("given") + F.col("pos") - F.col("h")).alias("pos"), "digest", "chars"))
    return convs.select("conv"), head.unionByName(own)


# --------------------------------------------------------------------------- the trie

def _hashes(*parts: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit("one"), *parts), F.xxhash64(F.lit("two"), *parts)


def _running(df: DataFrame, order: str, totals: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with running values along each ``conv``: name -> (column, "sum" or "bit_xor"), the row itself included.

    A conversation is summed in spans of ``SPAN`` orders, then over its spans, so that no task holds more than a span of it."""
    agg = {"sum": F.sum, "bit_xor": F.bit_xor}
    df = df.withColumn("span", F.floor(F.col(order) / SPAN).cast("long"))
    inside = Window.partitionBy("conv", "span").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = df.groupBy("conv", "span").agg(*[agg[how](c).alias(f"total_{n}") for n, (c, how) in totals.items()])
    spans = spans.select("conv", "span", *[agg[how](f"total_{n}").over(before).alias(f"before_{n}") for n, (_, how) in totals.items()])
    spans = spans.where(F.col("span") > 0)
    out = df.select("*", *[agg[how](c).over(inside).alias(n) for n, (c, how) in totals.items()]).join(spans, ["conv", "span"], "left")
    for n, (_, how) in totals.items():
        prior = F.coalesce(f"before_{n}", F.lit(0).cast("long"))
        out = out.withColumn(n, F.col(n) + prior if how == "sum" else F.col(n).bitwiseXOR(prior))
    return out.drop("span", *[f"before_{n}" for n in totals])


def _blocks(turns: DataFrame) -> DataFrame:
    """(conv, k, digests, chars, p1, p2, q1, q2): the blocks of each conversation, with the prefix keys before and after them."""
    block = F.floor(F.col("pos") / BLOCK).cast("long")
    rows = (turns.groupBy("conv", block.alias("k")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("turns"))
            .select("conv", "k", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars")))
    h1, h2 = _hashes(F.col("k"), F.col("digests"))
    rows = _running(stage(rows.withColumn("h1", h1).withColumn("h2", h2), "trie-blocks"), "k", {"q1": ("h1", "bit_xor"), "q2": ("h2", "bit_xor")})
    return rows.select("conv", "k", "digests", "chars", F.col("q1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("q2").bitwiseXOR(F.col("h2")).alias("p2"), "q1", "q2")


def _at(**of: str | Column) -> list[Column]:
    """The columns of a node's key; what is not given is 0."""
    return [(F.col(of[c]) if isinstance(of.get(c), str) else of.get(c, F.lit(0))).cast("long").alias(c) for c in _KEY]


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each node of the trie over ``convs`` (conv; also those without turns) and ``turns`` (conv, pos, digest, chars):

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    convs = convs.select("conv").distinct()
    blocks = stage(_blocks(turns), "trie-keys")

    # groups of conversations by block keys; the root is the group before the first block
    root = convs.agg(F.min("conv").alias("label"), F.count("*").alias("n")).where(F.col("n") > 0).select(*_at(), "label", "n")
    groups = stage(blocks.groupBy("k", "q1", "q2").agg(F.min("conv").alias("label"), F.count("*").alias("n"), F.max("p1").alias("p1"), F.max("p2").alias("p2")),
                   "trie-groups")
    after = groups.select(*_at(k=F.col("k") + 1, p1="q1", p2="q2"), "label", "n").unionByName(root)
    met = stage(groups.join(after.select("k", "p1", "p2", F.col("n").alias("n_before")), ["k", "p1", "p2"])
                .select("k", "q1", "q2", "label", "n", (F.col("n") == F.col("n_before")).alias("whole")), "trie-met")

    # a block that a whole group shares is a chain of nodes with the same members
    chain = (met.where("whole").withColumnRenamed("label", "conv").join(blocks.select("conv", "k", "chars"), ["conv", "k"])
             .select(F.col("conv").alias("label"), F.col("conv").alias("parent"), "n", "k", "q1", "q2", F.posexplode("chars").alias("i", "chars"))
             .select(*_at(k=F.col("k") + 1, p1="q1", p2="q2"), "label", "parent", (F.col("k") * BLOCK + F.col("i") + 1).alias("depth"), "n", "chars"))

    # where members diverge, each of the block's turns is a boundary
    apart = blocks.join(met.where(~F.col("whole")).select("k", "q1", "q2"), ["k", "q1", "q2"])
    apart = apart.select("conv", "k", "p1", "p2", "digests", F.posexplode("chars").alias("i", "chars"))
    y1, y2 = _hashes(F.slice("digests", F.lit(1), F.col("i") + 1))
    up1, up2 = (F.when(F.col("i") > 0, y).otherwise(0) for y in _hashes(F.slice("digests", F.lit(1), F.greatest(F.col("i"), F.lit(1)))))
    apart = stage(apart.select("conv", *_at(k="k", p1="p1", p2="p2", r=F.col("i") + 1, y1=y1, y2=y2), "chars", up1.alias("up1"), up2.alias("up2")), "trie-apart")
    split = stage(apart.groupBy(*_KEY).agg(F.min("conv").alias("label"), F.count("*").alias("n"), F.max("chars").alias("chars"),
                                           F.max("up1").alias("up1"), F.max("up2").alias("up2")), "trie-split")
    above = split.select(*_KEY, "label").unionByName(after.select(*_KEY, "label"))
    above = above.select("k", "p1", "p2", F.col("r").alias("up"), F.col("y1").alias("up1"), F.col("y2").alias("up2"), F.col("label").alias("parent"))
    fork = (split.withColumn("up", F.col("r") - 1).join(above, ["k", "p1", "p2", "up", "up1", "up2"])
            .select(*_KEY, "label", "parent", (F.col("k") * BLOCK + F.col("r")).alias("depth"), "n", "chars"))
    top = root.select(*_KEY, "label", F.lit(None).cast("long").alias("parent"), F.lit(0).cast("long").alias("depth"), "n", F.lit(0).cast("long").alias("chars"))
    nodes = stage(chain.unionByName(fork).unionByName(top).withColumn("own", (F.col("n") - 1) * F.col("chars")), "trie-nodes")

    # the node at which each conversation ends: in a chain the group's, else by the digest of its whole last block
    last = blocks.groupBy("conv").agg(F.max("k").alias("k"))
    ending = (blocks.join(last, ["conv", "k"]).select("conv", "k", "p1", "p2", "q1", "q2", "digests", F.size("digests").alias("r"))
              .join(met, ["k", "q1", "q2"]))
    e1, e2 = _hashes(F.col("digests"))
    apart_keys = {"k": "k", "p1": "p1", "p2": "p2", "r": "r", "y1": e1, "y2": e2}
    ends = (ending.where("whole").select("conv", "label", (F.col("k") * BLOCK + F.col("r")).alias("depth"))
            .unionByName(ending.where(~F.col("whole")).select("conv", *_at(**apart_keys)).join(split.select(*_KEY, "label"), _KEY)
                         .select("conv", "label", (F.col("k") * BLOCK + F.col("r")).alias("depth")))
            .unionByName(convs.join(last, "conv", "left_anti").select("conv", F.lit(0).cast("long").alias("depth"))
                         .join(top.select("label", "depth"), "depth").select("conv", "label", "depth")))
    ends = stage(ends, "trie-ends")

    # leaves and savings are booked on the naming conversation and summed over members
    ended = ends.groupBy("label", "depth").agg(F.count("*").alias("n_ended"))
    leaves = nodes.join(ended, ["label", "depth"]).where(F.col("n") == F.col("n_ended")).select(F.col("label").alias("conv"), F.lit(1).cast("long").alias("leaf"), F.lit(0).cast("long").alias("own"))
    booked = (nodes.where(F.col("own") != 0).select(F.col("label").alias("conv"), F.lit(0).cast("long").alias("leaf"), "own").unionByName(leaves)
              .groupBy("conv").agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own")))
    booked = stage(booked, "trie-booked")
    sums = (blocks.select("conv", *_at(k=F.col("k") + 1, p1="q1", p2="q2")).unionByName(apart.select("conv", *_KEY)).join(booked, "conv")
            .unionByName(booked.select("conv", *_at(), "leaf", "own")).groupBy(*_KEY).agg(F.sum("leaf").alias("n_leaves"), F.sum("own").alias("all_own")))
    above_own = _running(nodes.select(F.col("label").alias("conv"), "depth", "own"), "depth", {"so_far": ("own", "sum")})
    above_own = above_own.select(F.col("conv").alias("label"), "depth", (F.col("so_far") - F.col("own")).alias("above"))
    children = nodes.where(F.col("depth") > 0).groupBy(F.col("parent").alias("label"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    out = (nodes.join(sums, _KEY, "left").join(above_own, ["label", "depth"]).join(children, ["label", "depth"], "left")
           .join(_id_digests(ends), ["label", "depth"], "left"))
    none = F.lit(0).cast("long")
    return out.select(F.col("label").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                      F.coalesce("n_children", none).alias("n_children"), F.coalesce("n_leaves", none).alias("n_leaves"),
                      (F.coalesce("all_own", none) - F.col("above")).alias("saved_tokens"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def _id_digests(ends: DataFrame) -> DataFrame:
    """(label, depth, sha): SHA-256 over the ascending, comma-joined ids of the conversations that end at each node.

    Ids are packed into rows of ``CHUNK`` characters by range-sorted tasks, so a node with a third of all conversations is spread; its packed
    rows are then hashed as a stream, which a SHA-256 over one list needs, without holding them."""
    packed_schema = pa.schema([("label", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    sha_schema = pa.schema([("label", pa.int64()), ("depth", pa.int64()), ("sha", pa.string())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size = None, [], 0
        for batch in batches:
            out = []
            for label, depth, conv in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if ids and (node != (label, depth) or size > CHUNK):
                    out.append((*node, int(ids[0]), ",".join(ids)))
                    ids, size = [], 0
                node = (label, depth)
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield _batch(out, packed_schema)
        if ids:
            yield _batch([(*node, int(ids[0]), ",".join(ids))], packed_schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            out = []
            for label, depth, _, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if node != (label, depth):
                    if node:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (label, depth), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield _batch(out, sha_schema)
        if node:
            yield _batch([(*node, sha.hexdigest())], sha_schema)

    order = ["label", "depth", "conv"]
    packed = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, "label long, depth long, first long, ids string")
    return (packed.repartition("label", "depth").sortWithinPartitions("label", "depth", "first")
            .mapInArrow(digest, "label long, depth long, sha string"))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def conversation_trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The prefix trie of the conversations in ``rows``."""
    turns = stage(ordered_turns(rows, conv, turn, role, text), "trie-turns")
    return prefix_trie(turns.select("conv"), turns)
