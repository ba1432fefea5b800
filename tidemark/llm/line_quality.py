"""Quality rules (8): cross-document line frequency per host.

Lines are normalised (ASCII lower case, white space collapsed) and hashed.  For each
host the distinct documents holding a line are counted, exact copies of a text counting
as one document.  Lines over the host's limit are removed; documents left depleted are
rejected.  Base rules on a document's own words reject it as well.

Defined results: null and empty texts have no words and fail the base rules; a null host
is a host of its own; repeated rows are judged alike; an empty table gives an empty
result; other columns are carried or ignored, whatever their names.

Plan: one Python pass over the texts writes a slim table (counts and line hashes); the
counting is two partial aggregations, so a host or line with a third of all rows is
reduced before the shuffle; the frequent lines are written, and Spark joins them by their
size (AQE splits a hot line if it is not broadcast).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import boxed, gram_hashes, hash64, mapped, mix64, ship, stage, text_bytes, unboxed

ship(__name__)

_SYMBOLS = b"#*$%&|<>"
_NOT_A_WORD_CHAR = b" \t\n\r\x0b\x0c" + bytes(range(0x80, 0xC0))  # white space, and all but the first byte of a code point
WINDOW = 8

SLIM = ("rid long, host long, text_key long, text_len long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, line_hash array<long>, line_at array<int>, line_words array<int>")


def repeated_words(words: list[bytes], n: int = WINDOW) -> int:
    """Words covered by windows of ``n`` words that occur twice or more."""
    if len(words) <= n:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    g = gram_hashes(mix64(ids.view(np.uint64) + np.uint64(1)), n)
    order = np.argsort(g, kind="stable")
    same = g[order][1:] == g[order][:-1]
    if not same.any():
        return 0
    at = np.sort(order[np.append(same, False) | np.append(False, same)])
    grams = np.lib.stride_tricks.sliding_window_view(ids, n)[at]  # equal hashes are compared word by word
    _, back, count = np.unique(grams, axis=0, return_inverse=True, return_counts=True)
    at = at[count[back.reshape(-1)] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + n, -1)
    return int((np.cumsum(cover) > 0).sum())


def _measure(cols: dict[str, list]) -> dict[str, list]:
    out: dict[str, list] = {k.split()[0]: [] for k in SLIM.split(", ")}
    for k in ("rid", "host", "text_key", "text_len"):
        out[k] = cols[k]
    for text in cols["text"]:
        words = text.split()
        hashes, at, counts, plain = [], [], [], []
        for i, line in enumerate(text.split(b"\n")):
            own = line.split()
            if own:
                plain.append(line)
                hashes.append(hash64(b" ".join(own).lower()) - 2**63)
                at.append(i)
                counts.append(len(own))
        out["n_words"].append(len(words))
        out["word_chars"].append(len(text.translate(None, _NOT_A_WORD_CHAR)))
        out["n_symbols"].append(len(text) - len(text.translate(None, _SYMBOLS)))
        out["n_dup_lines"].append(len(plain) - len(set(plain)))
        out["n_repeat_words"].append(repeated_words(words))
        out["line_hash"].append(hashes)
        out["line_at"].append(at)
        out["line_words"].append(counts)
    return out


def frequent_lines(slim: DataFrame, max_share: float, min_docs: int, max_docs: int | None = None) -> DataFrame:
    """(host, line, n_docs) of the lines in more distinct documents of their host than both limits allow, or than ``max_docs``."""
    over = (F.col("n_docs") > min_docs) & (F.col("n_docs") > F.lit(max_share) * F.col("host_docs"))
    if max_docs is not None:
        over |= F.col("n_docs") > max_docs
    distinct = slim.groupBy("host", "text_key", "text_len").agg(F.first("line_hash").alias("line_hash"))
    hosts = slim.groupBy("host", "text_key", "text_len").agg(F.lit(1)).groupBy("host").agg(F.count("*").alias("host_docs"))
    return (distinct.select("host", F.explode(F.array_distinct("line_hash")).alias("line"))
            .groupBy("host", "line").agg(F.count("*").alias("n_docs"))
            .where(F.col("n_docs") > (min_docs if max_docs is None else min(min_docs, max_docs)))
            .join(hosts, "host")
            .where(over)
            .select("host", "line", "n_docs"))


def judge(docs: DataFrame, text: str = "text", host: str | None = "source", id_col: str | None = "doc_id", *,
          max_share: float = 0.10, min_docs: int = 10, max_docs: int | None = None, min_words: int = 20, min_left: float = 0.5,
          max_repeat: float = 0.30, with_docs: bool = False) -> DataFrame:
    """One row for each document: counts, ``removed_words``, ``base_failed``, ``kept``.

    A line goes when more than ``min_docs`` and more than ``max_share`` of the host's distinct documents hold it.
    The share grows with the host without bound; with ``max_docs`` a line in more distinct documents than that goes too, whatever its share.
    A document is depleted when fewer than ``min_words`` words, or less than ``min_left`` of its words, are left.
    ``with_docs`` adds the documents' columns as ``c0, c1, ...`` and ``removed_lines`` (line numbers from 0).
    """
    host_col = F.xxhash64(docs[host]) if host else F.lit(0).cast("long")
    if with_docs:
        box = stage(boxed(docs, host_col.alias("host")), "quality-docs")
        text_col = F.col(f"c{docs.columns.index(text)}")
        source = box.select("rid", "host", text_col.alias("t"))
        carried = []
    else:
        source = docs.select(F.monotonically_increasing_id().alias("rid"), host_col.alias("host"), docs[text].alias("t"),
                             *([docs[id_col].alias("doc_id")] if id_col else []))
        carried = ["doc_id"] if id_col else []
    fields = SLIM + ("".join(f", {c} {dict(source.dtypes)[c]}" for c in carried))

    def measure(cols: dict[str, list]) -> dict[str, list]:
        return _measure(cols) | {c: cols[c] for c in carried}

    slim = stage(mapped(source.select("rid", "host", F.xxhash64(F.coalesce("t", F.lit(""))).alias("text_key"),
                                      F.length(F.coalesce("t", F.lit(""))).cast("long").alias("text_len"), text_bytes("t").alias("text"), *carried),
                        measure, fields), "quality-slim")
    bad = stage(frequent_lines(slim, max_share, min_docs, max_docs), "quality-lines")
    hits = (slim.select("rid", "host", F.explode(F.arrays_zip("line_hash", "line_at", "line_words")).alias("x"))
            .select("rid", "host", F.col("x.line_hash").alias("line"), F.col("x.line_at").alias("at"), F.col("x.line_words").alias("n"))
            .join(bad.select("host", "line"), ["host", "line"])
            .groupBy("rid").agg(F.sum("n").cast("long").alias("removed_words"),
                                *([F.collect_list("at").alias("removed_lines")] if with_docs else [])))
    out = slim.drop("line_hash", "line_at", "line_words", "host", "text_key", "text_len").join(hits, "rid", "left")
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    out = (out.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
           .withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > int(round(100 * max_repeat)) * F.col("n_words")))
           .withColumn("kept", ~F.col("base_failed") & (left >= min_words) & (left >= F.lit(min_left) * F.col("n_words"))))
    return out.join(box, "rid") if with_docs else out.drop("rid")


def clean(docs: DataFrame, text: str = "text", host: str | None = "source", **limits) -> DataFrame:
    """The documents that pass, in their own columns, their texts without the frequent lines (and ``n_chars``, if there, counted anew)."""
    rows = judge(docs, text, host, None, with_docs=True, **limits).where("kept")
    box = f"c{docs.columns.index(text)}"
    gone = F.coalesce("removed_lines", F.array().cast("array<int>"))
    lines = F.filter(F.split(F.col(box), "\n", -1), lambda line, i: ~F.array_contains(gone, i))
    rows = rows.withColumn(box, F.when(F.size(gone) > 0, F.array_join(lines, "\n")).otherwise(F.col(box)))
    if "n_chars" in docs.columns:
        c = f"c{docs.columns.index('n_chars')}"
        rows = rows.withColumn(c, F.when(F.size(gone) > 0, F.length(box).cast(docs.schema["n_chars"].dataType)).otherwise(F.col(c)))
    return rows.select(*unboxed(docs.columns))
