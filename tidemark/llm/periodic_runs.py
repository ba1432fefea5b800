"""Periodic run detection (11): recursive frequency splitting, then a lag scan of what survives.

A run is a stretch of consecutive words with smallest period q and at least max(``min_run``, 2 q) words
that no neighbouring word extends.  Every word of a run occurs twice or more in it, so a word that occurs
once in its segment is in no run and splits the segment.  The parts are split again by their own counts
until no word is rare; parts of under ``min_run`` words are dropped.

The survivors are scanned lag by lag.  Up to ``DENSE`` words every place is compared with the place one lag on.
A longer lag q is only looked at on places q // 8 apart: the equal stretch of a run holds eight of them in a row, and
where eight in a row agree the stretch is compared word by word.  So a segment of m words costs about
8 m log(m) comparisons, not m * m.  A multiple of a known run's period inside that run is skipped.
Hash tables only number the words of a text; all comparisons are exact.

Defined results: null and empty texts have no words and no runs; a text of any length is one row's work (its words,
as numbers, are held by one task); repeated rows give equal rows; an empty table gives an empty result; other columns
are not read, whatever their names.  Runs are ordered by start, then period; of runs of equal length the
smallest start is the longest run.

Plan: one Python pass over the texts, no shuffle.  Rows are independent, so a lost executor costs its own tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, ship, text_bytes

ship(__name__)

MIN_RUN = 12
#: Lags that are scanned at every place; from there on, eight places a lag.
DENSE = 32
POINTS = 8

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def segments(ids: np.ndarray, min_run: int = MIN_RUN) -> list[tuple[int, int]]:
    """(start, end) of the segments that are left when words occurring once in their segment split it, again and again."""
    work, done = [np.arange(len(ids), dtype=np.int64)] if len(ids) >= min_run else [], []
    while work:
        at = np.concatenate(work)
        # each segment is a stretch of consecutive places; between two of them at least one place is missing
        seg = np.cumsum(np.concatenate(([0], np.diff(at) != 1)))
        size = int(ids[at].max()) + 1
        key = seg * size + ids[at]
        if seg[-1] == 0:
            often = np.bincount(key)[key] > 1
        else:
            _, back, count = np.unique(key, return_inverse=True, return_counts=True)
            often = count[back] > 1
        split = np.bincount(seg, weights=~often) > 0
        left = at[often]
        work = []
        if len(left):
            whose = seg[often]
            cuts = np.flatnonzero(np.diff(left) != 1) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(left)]))
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                if b - a >= min_run:
                    if split[whose[a]]:
                        work.append(left[a:b])
                    else:
                        done.append((int(left[a]), int(left[b - 1]) + 1))
    return sorted(done)


def _stretches(same: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Bounds of the maximal stretches of at least ``least`` true places."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).view(np.int8)))
    return [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if b - a >= least]


def _scan(x: np.ndarray, min_run: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs of one segment, by ascending lags."""
    m, found, ends = len(x), [], set()

    def add(start: int, end: int, lag: int) -> None:
        # with a smaller period too, the stretch has been found whole under it
        if (start, end) not in ends:
            ends.add((start, end))
            found.append((start, end, lag))

    for lag in range(1, min(DENSE, m // 2) + 1):
        same = x[lag:] == x[:-lag]
        least = max(min_run - lag, lag)
        if np.count_nonzero(same) >= least:
            for a, b in _stretches(same, least):
                add(a, b + lag, lag)
    for lag in range(DENSE + 1, m // 2 + 1):
        step = lag // POINTS
        same = x[:m - lag:step] == x[lag::step]
        if np.count_nonzero(same) < POINTS:
            continue
        for a, b in _stretches(same, POINTS):
            first, last = a * step, (b - 1) * step
            if any(lag % d == 0 and s <= first and last < e - lag for s, e, d in found):
                continue
            lo, hi = max(0, first - step + 1), min(last + step, m - lag)
            for c, d in _stretches(x[lo:hi] == x[lo + lag:hi + lag], lag):
                add(lo + c, lo + d + lag, lag)
    return found


def runs_of(words: list, min_run: int = MIN_RUN) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    out = [(s + a, b - a, q) for s, e in segments(ids, min_run) for a, b, q in _scan(ids[s:e], min_run)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def find_runs(docs: DataFrame, text: str = "text", id_col: str = "doc_id", min_run: int = MIN_RUN) -> DataFrame:
    """One row for each row of ``docs``: its id, ``n_words``, ``runs`` (start, length, period) and ``collapsed``,
    the words that are left (joined by a space) when runs are cut to their first period."""
    if min_run < 2:
        raise ValueError("a run has two words at least")
    kind = docs.schema[id_col].dataType.simpleString()

    def measure(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"id": cols["id"], "n_words": [], "runs": [], "collapsed": []}
        for t in cols["text"]:
            words = t.split()
            runs = runs_of(words, min_run)
            out["n_words"].append(len(words))
            out["runs"].append([{"start": s, "length": n, "period": q} for s, n, q in runs])
            out["collapsed"].append(b" ".join(collapse(words, runs)))
        return out

    source = docs.select(docs[id_col].alias("id"), text_bytes(docs[text]).alias("text"))
    out = mapped(source, measure, f"id {kind}, n_words long, runs {RUNS}, collapsed binary")
    return out.select(F.col("id").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def repeated_tails(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The fixture of the registered query: (id, text) where a tenth of the texts, chosen by the crc32 of the id, repeat a part.

    With h = crc32(decimal id), g = h // 10 and n words: if h % 10 = 0, each word from a = g % n on becomes word
    a + (i - a) % p with p = 1 + (n - a) // (3 + g % 8).  A null id or text changes nothing.
    """
    h = F.crc32(docs[id_col].cast("string").cast("binary"))
    rows = docs.select(docs[id_col].alias("id"), docs[text].alias("t"), h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.regexp_extract_all("t", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size("w").cast("long")
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, words))
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), n - F.col("a") - 1),
                       lambda i: F.element_at("w", (F.col("a") + i % F.col("p") + 1).cast("int")))
    made = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), tail), " ")
    return rows.select(F.col("id").alias(id_col), F.when(F.col("a").isNotNull(), made).otherwise(F.col("t")).alias(text))


def run_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the longest run, and digests of the runs and of the collapsed text."""
    runs = F.col("runs")
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"),
                                                           (-r["period"]).alias("shorter"))))
    out = found.select(id_col, F.size(runs).cast("long").alias("n_runs"), top.alias("top"), F.array_join(lines, "").alias("lines"), "collapsed")
    return out.select(
        id_col, "n_runs", (-F.col("top.before")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.shorter")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.shorter")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
