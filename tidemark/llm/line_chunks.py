"""Line dedup (4): content-defined chunks of lines.

Each line is hashed; a rolling hash over the last ``roll`` line hashes ends a chunk where it is 0 modulo
``mean_lines`` (from ``min_lines`` lines on, and at ``max_lines`` at the latest). The roll starts anew with each chunk, so
boundaries follow content and a shifted passage meets the same boundaries again. A chunk of ``min_lines``
or more lines that also stands in an earlier place (smaller doc_id, then earlier in the document) is removed. Chunks
found by hash are compared byte by byte: they are grouped on their bytes.

Lines are split at ``\\n``; kept chunks are joined again with ``\\n``, so a text without removals keeps every byte.

Defined results: a null text has no lines and stays null; an empty text is one empty line and is never removed; a null doc_id
counts as the smallest; of texts with one doc_id the one with the lesser hash comes first; rows alike in doc_id and text are one
document and get the same result; an empty table gives an empty result. Blank lines are lines. A chunk without any word is never
removed. Other columns are ignored or carried.

Plan: hashes are counted first, map-side. Only documents that hold a repeated hash are moved (their texts once), and only
the bytes of repeated chunks are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash64, mapped, ship, stage, text_bytes

ship(__name__)


def chunk_ends(hashes: list[int], min_lines: int, mean_lines: int, max_lines: int, roll: int) -> list[int]:
    """Ends (exclusive) of the chunks of a document's line hashes."""
    ends, start = [], 0
    for i in range(len(hashes)):
        n = i + 1 - start
        if n < min_lines:
            continue
        value = 0
        for h in hashes[max(start, i + 1 - roll):i + 1]:
            value = (value * 0x9E3779B97F4A7C15 + h) & 2**64 - 1
        if (value >> 32) % mean_lines == 0 or n >= max_lines:
            ends.append(i + 1)
            start = i + 1
    return ends + ([len(hashes)] if start < len(hashes) else [])


class Cutter:
    """Chunks of texts for one set of sizes."""

    def __init__(self, min_lines: int, mean_lines: int, max_lines: int, roll: int):
        self.min_lines, self.sizes = min_lines, (min_lines, mean_lines, max_lines, roll)

    def chunks(self, text: bytes) -> Iterator[tuple[int, list[bytes]]]:
        lines, start = text.split(b"\n"), 0
        for no, end in enumerate(chunk_ends([hash64(x) for x in lines], *self.sizes)):
            yield no, lines[start:end]
            start = end

    def table(self, cols: dict[str, list], with_bytes: bool) -> dict[str, list]:
        """The chunks that may be removed."""
        out: dict[str, list] = {"rid": [], "doc": [], "no": [], "key": [], "lines": []} | ({"body": []} if with_bytes else {})
        for rid, doc, text in zip(cols["rid"], cols["doc"], cols["text"], strict=True):
            for no, lines in self.chunks(text):
                body = b"\n".join(lines)
                if len(lines) >= self.min_lines and body.strip():
                    for name, value in zip(out, (rid, doc, no, hash64(body) - 2**63, len(lines), body), strict=False):
                        out[name].append(value)
        return out

    def cut(self, cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"rid": cols["rid"], "gone_chunks": [], "gone_lines": cols["gone_lines"], "cut": []}
        for text, gone in zip(cols["text"], cols["gone"], strict=True):
            off = set(gone)
            out["gone_chunks"].append(len(off))
            out["cut"].append(b"\n".join(x for no, lines in self.chunks(text) if no not in off for x in lines).decode("utf-8", "replace"))
        return out


def _rid(docs: DataFrame, text: str, doc_id: str) -> Column:
    return F.xxhash64(docs[doc_id], docs[text])


def changed_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, min_lines: int = 2, mean_lines: int = 3, max_lines: int = 16,
                  roll: int = 2) -> DataFrame:
    """(rid, gone_chunks, gone_lines, cut) of the documents that lose a chunk; ``rid`` is a hash of doc_id and text."""
    cutter = Cutter(min_lines, mean_lines, max_lines, roll)
    fields = "rid long, doc long, no int, key long, lines int"
    texts = docs.select(_rid(docs, text, doc_id).alias("rid"), F.coalesce(docs[doc_id].cast("long"), F.lit(-2**63).cast("long")).alias("doc"),
                        text_bytes(docs[text]).alias("text"))
    slim = stage(mapped(texts, lambda c: cutter.table(c, False), fields), "chunks-slim")
    place = F.struct("rid", "no")
    twice = stage(slim.groupBy("key").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("key"), "chunks-twice")
    holders = slim.join(twice, "key", "left_semi").select("rid").distinct()
    # What follows the corpus in size is not broadcast, however small it is here: one plan at every size.
    held = stage(texts.join(holders.hint("merge"), "rid", "left_semi").dropDuplicates(["rid"]), "chunks-held")
    again = stage(mapped(held, lambda c: cutter.table(c, True), fields + ", body binary", rows=128).join(twice, "key", "left_semi"), "chunks-again")
    # Written, so that AQE can split the rows of a hot chunk in the join below.
    first = stage(again.groupBy("key", "body").agg(F.min(F.struct("doc", "rid", "no")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "chunks-first")
    gone = (again.join(first, ["key", "body"]).where(F.struct("doc", "rid", "no") > F.col("first"))
            .groupBy("rid").agg(F.collect_list("no").alias("gone"), F.sum("lines").cast("long").alias("gone_lines")))
    return mapped(held.select("rid", "text").join(gone.hint("merge"), "rid"), cutter.cut, "rid long, gone_chunks long, gone_lines long, cut string", rows=128)


def _counts(docs: DataFrame, text: str) -> Column:
    return F.coalesce(F.length(F.regexp_replace(docs[text], "[^\n]+", "")) + 1, F.lit(0)).cast("long").alias("n_lines")


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **sizes) -> DataFrame:
    """The documents in their own columns, repeated chunks cut out of the texts."""
    made = changed_texts(docs, text, doc_id, **sizes).select("rid", "cut")
    both = docs.join(made, _rid(docs, text, doc_id) == made["rid"], "left")
    return both.select(*[F.coalesce(made["cut"], docs[c]).alias(c) if c == text else docs[c] for c in docs.columns])


def line_digest(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **sizes) -> DataFrame:
    """(doc_id, n_lines, removed_chunks, removed_lines, kept_sha256) of every row; the checksum is of the text that stays, null for null."""
    made = changed_texts(docs, text, doc_id, **sizes).select("rid", "gone_chunks", "gone_lines", F.sha2("cut", 256).alias("cut"))
    rows = docs.select(_rid(docs, text, doc_id).alias("rid"), docs[doc_id].alias("doc_id"), _counts(docs, text), F.sha2(docs[text], 256).alias("whole"))
    none = F.lit(0).cast("long")
    return rows.join(made, "rid", "left").select("doc_id", "n_lines", F.coalesce("gone_chunks", none).alias("removed_chunks"),
                                                 F.coalesce("gone_lines", none).alias("removed_lines"), F.coalesce("cut", "whole").alias("kept_sha256"))
