"""Substring dedup (6): suffix automata of reference shards, matching statistics of the documents.

A window is 50 consecutive words ``[^\\x20\\x09-\\x0D]+`` of one document.  Words covered by a window that
also starts in a document with a smaller doc_id are removed; windows are judged on the input.

The corpus is its own reference, so the automata of all shards can't go to all tasks.  What each document
has to be streamed against is found first, by hashes reduced map-side:

1. Anchors. Of the 16-word grams of each window the least by hash is the window's anchor; equal windows have
   equal anchors. Anchors of two or more documents are shared (about one anchor for 18 words).
2. The windows of shared anchors are hashed; for each hash the least doc_id is the window's *reference document*.
3. A reference shard is the set of a reference document's repeated spans (bounded by the document). Its
   suffix automaton is broadcast to as many tasks as the passages citing it need (a shard cited by a third of all documents is
   salted; each task holds one automaton), and the citing passages are streamed through it. Their
   matching statistics are word by word, so a hash collision removes nothing; maximal spans of 50 words or more go.
4. The spans are merged for each document and the kept text is written.

Defined results: null, empty and short texts stay as they are; a null doc_id counts as the
smallest; documents with equal doc_ids don't cite each other; repeated rows get the same result; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, discard, gram_hashes, grouped, mapped, ship, signed, stage, text_bytes

ship(__name__)

WINDOW = 50
ANCHOR = 16
TASK_WORDS = 200_000


def anchors(h: np.ndarray, window: int, k: int) -> np.ndarray:
    """For each window start the hash of its anchor."""
    g = gram_hashes(h, k)
    span = window - k + 1
    if len(g) < span:
        return np.empty(0, np.uint64)
    return np.lib.stride_tricks.sliding_window_view(g, span).min(axis=1)


class SuffixAutomaton:
    """Suffix automaton of several word sequences (a state is never shared across their ends)."""

    def __init__(self, passages: list[list[bytes]]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for k, words in enumerate(passages):
            for w in (*words, k):  # the number k ends passage k; words are bytes
                last = self._extend(last, w)

    def _extend(self, last: int, w: bytes | int) -> int:
        nxt, link, length = self.next, self.link, self.length
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(w) == q:
                    nxt[p][w] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        return cur

    def matching_statistics(self, words: list[bytes]) -> list[int]:
        """For each word the length of the longest run ending there that occurs in a passage."""
        nxt, link, length = self.next, self.link, self.length
        state, n, out = 0, 0, []
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                n = length[state]
            to = nxt[state].get(w)
            if to is None:
                n = 0
            else:
                state, n = to, n + 1
            out.append(n)
        return out


def long_spans(stats: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal spans covered by matches of ``window`` words or more."""
    out: list[tuple[int, int]] = []
    for i, n in enumerate(stats):
        if n >= window:
            if out and i + 1 - window <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((i + 1 - window, i + 1))
    return out


def _runs(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Spans of words covered by windows of neighbouring starts."""
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    return [(int(p[0]), int(p[-1]) + window) for p in np.split(starts, cut) if len(p)]


def removed_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, window: int = WINDOW, anchor: int = ANCHOR,
                  task_words: int = TASK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(slim rows: rid, doc_id, n_words, sha256 of all words; changed: rid, n_removed, kept_sha256, kept text)."""
    kind = dict(docs.dtypes)[doc_id]
    least = F.lit(-2**63).cast("long")
    texts = docs.select(F.xxhash64(docs[doc_id], docs[text]).alias("rid"), docs[doc_id].alias("doc_id"),
                        F.coalesce(docs[doc_id].cast("long"), least).alias("doc"), text_bytes(docs[text]).alias("text"))

    known = WordHashes()  # each task has its own copy, for all its rows

    def sign(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"rid": cols["rid"], "doc_id": cols["doc_id"], "doc": cols["doc"], "n_words": [], "sha": [], "anchors": []}
        for t in cols["text"]:
            words = t.split()
            out["n_words"].append(len(words))
            out["sha"].append(hashlib.sha256(b" ".join(words)).digest())
            out["anchors"].append(signed(np.unique(anchors(known.of(words), window, anchor))).tolist() if len(words) >= window else [])
        return out

    slim = stage(mapped(texts, sign, f"rid long, doc_id {kind}, doc long, n_words long, sha binary, anchors array<long>", rows=2048), "spans-slim")
    each = slim.select("rid", "doc", F.explode("anchors").alias("anchor"))
    shared = each.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("anchor")
    own = each.select("rid", "anchor").join(shared, "anchor", "left_semi").groupBy("rid").agg(F.collect_set("anchor").alias("anchors"))
    box = stage(texts.drop("doc_id").join(own, "rid").dropDuplicates(["rid"]).withColumn("no", F.monotonically_increasing_id()), "spans-box")

    def windows(cols: dict[str, list]) -> dict[str, np.ndarray]:
        hashes, places = [], []
        for t, live in zip(cols["text"], cols["anchors"], strict=True):
            h = known.of(t.split())
            at = np.flatnonzero(np.isin(signed(anchors(h, window, anchor)), np.array(live, np.int64)))
            hashes.append(signed(gram_hashes(h, window)[at]))
            places.append(at.astype(np.int32))
        n = [len(p) for p in places]
        return {"w": np.concatenate(hashes), "no": np.repeat(np.array(cols["no"], np.int64), n), "doc": np.repeat(np.array(cols["doc"], np.int64), n),
                "at": np.concatenate(places)}

    # Written once, as both its first documents and its rows are needed.
    every = stage(mapped(box.select("no", "doc", "text", "anchors"), windows, "w long, no long, doc long, at int", rows=64), "spans-windows")
    # Written, so that the join below reads it through an exchange of its own and AQE can split a hot window's rows.
    first = stage(every.groupBy("w").agg(F.min("doc").alias("first"), F.max("doc").alias("hi")).where("first < hi").select("w", "first"), "spans-first")
    cited = stage(every.select("w", "no", "at").join(first, "w").groupBy("no").agg(F.collect_list(F.struct("first", "at")).alias("cited")), "spans-cited")
    discard(every, first)

    def passages(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"ref": [], "kind": [], "no": [], "at": [], "words": [], "n": []}
        for no, doc, t, rows in zip(cols["no"], cols["doc"], cols["text"], cols["cited"], strict=True):
            words = t.split()
            by = np.array([(r["first"], r["at"]) for r in rows], np.int64)
            by = by[np.lexsort((by[:, 1], by[:, 0]))]
            refs, starts = np.unique(by[:, 0], return_index=True)
            for ref, at in zip(refs.tolist(), np.split(by[:, 1], starts[1:]), strict=True):
                for a, b in _runs(at, window):
                    out["ref"].append(ref)
                    out["kind"].append(int(ref != doc))
                    out["no"].append(no)
                    out["at"].append(a)
                    out["words"].append(b" ".join(words[a:b]))
                    out["n"].append(b - a)
        return out

    rows = stage(mapped(box.select("no", "doc", "text").join(cited, "no"), passages, "ref long, kind int, no long, at int, words binary, n int", rows=64), "spans-passages")
    discard(cited)
    salts = (rows.where("kind = 1").groupBy("ref").agg(F.sum("n").alias("total"))
             .select("ref", F.ceil(F.col("total") / task_words).cast("long").alias("salts")))
    rows = rows.join(salts, "ref")
    shards = rows.where("kind = 0").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    streamed = rows.where("kind = 1").withColumn("salt", F.pmod(F.xxhash64("no", "at"), "salts"))

    def stream(g: dict[str, list]) -> dict[str, list] | None:
        of = [w.split(b" ") for w, k in zip(g["words"], g["kind"], strict=True) if k == 0]
        out: dict[str, list] = {"no": [], "from": [], "to": []}
        if not of:
            return None
        automaton = SuffixAutomaton(of)
        for words, k, no, at in zip(g["words"], g["kind"], g["no"], g["at"], strict=True):
            if k:
                for a, b in long_spans(automaton.matching_statistics(words.split(b" ")), window):
                    out["no"].append(no)
                    out["from"].append(at + a)
                    out["to"].append(at + b)
        return out

    gone = (grouped(shards.unionByName(streamed).select("ref", "salt", "kind", "no", "at", "words"), ["ref", "salt"], stream, "no long, from int, to int", order=["kind"])
            .groupBy("no").agg(F.collect_list(F.struct("from", "to")).alias("spans")))

    def cut(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"rid": cols["rid"], "n_removed": [], "kept_sha256": [], "kept": []}
        for t, spans in zip(cols["text"], cols["spans"], strict=True):
            words, keep = t.split(), None
            keep = bytearray(b"\1" * len(words))
            for s in spans:
                keep[s["from"]:s["to"]] = bytes(s["to"] - s["from"])
            kept = b" ".join(w for w, k in zip(words, keep, strict=True) if k)
            out["n_removed"].append(len(words) - sum(keep))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept.decode("utf-8", "replace"))
        return out

    changed = mapped(box.select("rid", "no", "text").join(gone, "no"), cut, "rid long, n_removed long, kept_sha256 string, kept string", rows=64)
    return slim.drop("anchors", "doc"), changed


def dedup_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **sizes) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    slim, changed = removed_spans(docs, text, doc_id, **sizes)
    return (slim.join(changed.drop("kept"), "rid", "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("kept_sha256", F.lower(F.hex("sha"))).alias("kept_sha256")))


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **sizes) -> DataFrame:
    """The documents in their own columns, repeated spans cut out of the texts (whose words are then joined by spaces)."""
    _, changed = removed_spans(docs, text, doc_id, **sizes)
    made = changed.select("rid", "kept").withColumnsRenamed({"rid": "__rid", "kept": "__kept"})
    both = docs.join(made, F.xxhash64(docs[doc_id], docs[text]) == made["__rid"], "left")
    return both.select(*[F.coalesce(made["__kept"], docs[c]).alias(c) if c == text else docs[c] for c in docs.columns])
