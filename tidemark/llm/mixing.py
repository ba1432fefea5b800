"""Mixing sources to target weights (10): temperature mixing, DataFrame operations only.

Source shares are raised to an exponent and normalised.  The exponent is bisected (each
round probes several points in one aggregate over the source table) until the mixture
meets a target entropy or a repetition limit.  Weights are realised as block permutations:
documents are dealt into blocks, each epoch of a source orders its blocks and the documents
in them by a keyed hash, and the last epoch ends where the source's token budget ends, in
the middle of a block if need be.

Without a budget the smallest one is taken at which every source passes whole at least
once, so no document is lost and small sources repeat up to the limit.

Defined results: a null source is a source of its own; null and empty texts have 0 tokens
and go with their block; sources without tokens pass once; repeated rows count each; an
empty table gives an empty result; other columns are carried or ignored.

Hot sources: documents are summed into blocks before any window, and a corpus has at most
about ``max_blocks`` blocks whatever its size, so the window over a source's blocks is bounded; the
window inside a block is bounded by the block's tokens.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import boxed, stage, unboxed

PROBES = 9
#: The greatest exponent tried: beyond it only the largest sources are left.
MOST = 1024.0


def n_words(text: str | Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def exponent(sources: DataFrame, *, entropy_share: float | None = None, repetition: float | None = None,
             budget: int | None = None, digits: int = 9) -> float:
    """The exponent nearest 0 (the flattest mixture) that meets the target; over 1 where the sources' own shares don't. An error if none does.

    ``entropy_share``: the entropy is this share of the greatest possible.  ``repetition``: no source passes more often.  With both, the
    entropy settles the exponent, and it is an error if the mixture breaks the repetition limit.
    """
    live = sources.where("tokens > 0")
    lo, hi = 0.0, 1.0
    total, count, least, most = live.agg(F.sum("tokens"), F.count("*"), F.min("tokens"), F.max("tokens")).first()
    if not count:
        return 1.0
    if count == 1 or least == most:  # any exponent gives the same mixture
        if (entropy_share is not None and count > 1 and entropy_share < 1 - 1e-12) or (
                entropy_share is None and repetition is not None and budget is not None and budget > repetition * total * (1 + 1e-12)):
            raise ValueError("sources of equal size give one mixture, which misses the target")
        return 1.0
    share = F.col("tokens") / F.lit(float(total))

    def moments(probes: list[float]) -> list[tuple[float, float]]:
        """For each exponent the sum of the powers, and of the powers times the logarithms: one aggregate over the sources."""
        got = live.agg(*[F.struct(F.sum(F.pow(share, F.lit(a))).alias("z"), F.sum(F.pow(share, F.lit(a)) * F.log(share)).alias("y")).alias(f"p{i}")
                         for i, a in enumerate(probes)]).first()
        return [(x["z"], x["y"]) for x in got]

    def meet(probes: list[float]) -> list[bool]:
        if entropy_share is not None:  # the entropy falls as the exponent grows
            return [math.log(z) - a * y / z <= entropy_share * math.log(count) for a, (z, y) in zip(probes, moments(probes), strict=True)]
        if budget is None:  # the rates of two sources differ by their sizes alone
            return [(most / least) ** (1 - a) <= repetition for a in probes]
        # the source passed most often is the smallest up to an exponent of 1, and the largest beyond
        return [budget * max((t / total) ** a / z / t for t in (least, most)) <= repetition * (1 + 1e-12) for a, (z, _) in zip(probes, moments(probes), strict=True)]

    if budget is None and entropy_share is None and repetition < 1:
        raise ValueError("no exponent passes every source once and none more than repetition")
    if budget is not None and entropy_share is None and budget > repetition * total * (1 + 1e-12):
        raise ValueError("the budget is over repetition times all tokens: no exponent meets the repetition limit")
    while entropy_share is not None and not meet([hi])[0]:
        lo, hi = hi, 2 * hi
        if hi > MOST:
            raise ValueError(f"no exponent up to {MOST} meets entropy_share {entropy_share}")
    while hi - lo > 10.0 ** -digits * max(1.0, hi):
        probes = [lo + (hi - lo) * i / (PROBES + 1) for i in range(1, PROBES + 1)]
        meets = meet(probes)
        first = meets.index(True) if True in meets else PROBES
        lo, hi = probes[first - 1] if first else lo, probes[first] if first < PROBES else hi
    if entropy_share is not None and repetition is not None:
        z = moments([hi])[0][0]
        # without a budget the source passed least often passes once
        often = ((most / least) ** abs(1 - hi) if budget is None else budget * max((t / total) ** hi / z / t for t in (least, most)))
        if often > repetition * (1 + 1e-9):
            raise ValueError(f"the mixture of entropy_share {entropy_share} passes a source {often:.3g} times, over repetition {repetition}")
    return hi


def plan(rows: DataFrame, *, entropy_share: float | None = None, repetition: float | None = None, budget: int | None = None,
         min_block_tokens: int = 65_536, max_blocks: int = 1_000_000, seed: int = 17) -> DataFrame:
    """Passes of staged rows (rid, skey, tokens): adds ``block, epoch, block_rank, weight, mix_pos`` and has a row for each pass."""
    sources = stage(rows.groupBy("skey").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "mix-sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    alpha = exponent(sources, entropy_share=entropy_share, repetition=repetition, budget=budget)
    block_tokens = max(min_block_tokens, total // max_blocks)
    z, cover = sources.where("tokens > 0").select((F.col("tokens") / F.lit(float(total or 1))).alias("p")).agg(
        F.sum(F.pow("p", F.lit(alpha))), F.max(F.pow("p", F.lit(1 - alpha)))).first()
    size = float(budget if budget is not None else total * (z or 0) * (cover or 0))
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(alpha)) / F.lit(z or 1.0)).otherwise(0.0)
    sources = (sources.withColumn("weight", weight).withColumn("quota", F.col("weight") * F.lit(size))
               .withColumn("whole", F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens") + F.lit(1e-9))).otherwise(1).cast("int"))
               .withColumn("rest", F.col("quota") - F.col("whole") * F.col("tokens"))
               .withColumn("rest", F.when((F.col("tokens") > 0) & (F.col("rest") > 0.5), F.col("rest")).otherwise(0.0))
               .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long"))
               .withColumnRenamed("tokens", "source_tokens").drop("docs"))
    dealt = stage(rows.join(sources.select("skey", "n_blocks"), "skey")
                  .withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "rid"), "n_blocks")).drop("n_blocks"), "mix-blocks")
    blocks = dealt.groupBy("skey", "block").agg(F.sum("tokens").alias("block_tokens"))
    order = Window.partitionBy("skey", "epoch").orderBy(F.xxhash64(F.lit(seed), "epoch", "skey", "block"), "block")
    passes = (blocks.join(sources, "skey")
              .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") + F.when(F.col("rest") > 0, 0).otherwise(-1))))
              .where("epoch >= 0")
              .withColumn("block_rank", F.row_number().over(order) - 1)
              .withColumn("before", F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("block_tokens"))
              .withColumn("room", F.when(F.col("epoch") == F.col("whole"), F.col("rest") - F.col("before")).otherwise(F.col("block_tokens").cast("double")))
              .where("room > 0 or block_tokens = 0")
              .withColumn("mix_pos", F.coalesce((F.col("epoch") * F.col("source_tokens") + F.col("before")) / F.nullif("quota", F.lit(0.0)), F.lit(0.0)))
              .select("skey", "block", "epoch", "block_rank", "block_tokens", "room", "mix_pos", "weight"))
    out = dealt.join(passes, ["skey", "block"])
    whole = out.where("room >= block_tokens")
    inside = Window.partitionBy("skey", "block", "epoch").orderBy(F.xxhash64(F.lit(seed), "epoch", "rid"), "rid").rowsBetween(Window.unboundedPreceding, 0)
    cut = (out.where("room < block_tokens").withColumn("upto", F.sum("tokens").over(inside))
           .where(F.col("upto") - F.col("tokens") / 2 <= F.col("room")).drop("upto"))
    return whole.unionByName(cut).drop("block_tokens", "room")


def mix(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", **target) -> DataFrame:
    """One row for each pass of a document: (doc_id, source, n_tokens, weight, epoch, block, block_rank, mix_pos).

    Sorting by ``mix_pos`` interleaves the sources at their weights.
    """
    rows = stage(docs.select(F.monotonically_increasing_id().alias("rid"), docs[doc_id].alias("doc_id"), docs[source].alias("source"),
                             F.xxhash64(docs[source]).alias("skey"), n_words(docs[text]).alias("tokens")), "mix-rows")
    return plan(rows, **target).select("doc_id", "source", F.col("tokens").alias("n_tokens"), "weight", "epoch", "block", "block_rank", "mix_pos")


def mixed_documents(docs: DataFrame, source: str = "source", text: str = "text", **target) -> DataFrame:
    """The documents themselves, each as often as its source passes it."""
    box = stage(boxed(docs, F.xxhash64(docs[source]).alias("skey"), n_words(docs[text]).alias("tokens")), "mix-docs")
    passes = plan(box.select("rid", "skey", "tokens"), **target).groupBy("rid").agg(F.count("*").cast("int").alias("n"))
    return (box.drop("skey", "tokens").join(passes, "rid").withColumn("copy", F.explode(F.sequence(F.lit(1), "n")))
            .select(*unboxed(docs.columns)))
