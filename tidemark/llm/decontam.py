"""Benchmark decontamination (7): a distributed positional inverted index.

For every window of a test item (13 consecutive words; all words of a shorter item) the
``terms_per_window`` rarest of its words are chosen by their document frequency in the training corpus.
The index stores the postings (term, document, position) of the chosen terms.  A list is
intersected by adjusting each position by the term's offset in the item: occurrences of one phrase lie on one
diagonal (document position minus item position), and a window can only occur where
all of its chosen terms meet on a diagonal.  Documents with such a window are compared word by
word, which gives the exact phrase matches.

With ``near`` the same index also gives proximity matches, so that a changed, added or left out word hides nothing: of each window of
``near_terms`` words or more, the ``near_terms`` rarest different words that the corpus has are chosen, and a document matches it nearly if
``near_least`` of them stand on diagonals that differ by ``slack`` at most.  ``contaminated`` follows the exact matches alone.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Defined results: a null or empty text has no words; an item without words never occurs; items
alike in text are each counted, by their ids: items of one id count once in n_items, so do those without id, which match like any other but
have nothing to give to items_sha256 and near_items; repeated documents are judged alike; an empty table on either side gives no hits; other columns
are ignored.

Scale: the test set is the stated query set and is taken in blocks of at most
``block_words`` words, so what is sent to the tasks is bounded; the corpus is scanned three times for each block and only
the postings of chosen terms, and the documents found, are shuffled.  Candidate windows are
reduced before and after each shuffle; no pairs of documents are formed.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import mapped, ship, stage, text_bytes

ship(__name__)

SPAN = 13
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def fold_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _item_blocks(bench: DataFrame, item_id: str, text: str, block_words: int) -> list[list[tuple[str | None, list[bytes]]]]:
    """The test items' words, in blocks; read a block at a time."""
    blocks, held, size = [], [], 0
    for r in bench.select(bench[item_id].cast("string").alias("i"), text_bytes(bench[text]).alias("t")).orderBy("i").toLocalIterator():
        words = fold_words(bytes(r["t"]))
        if words:
            held.append((r["i"], words))
            size += len(words)
        if size >= block_words:
            blocks.append(held)
            held, size = [], 0
    return blocks + ([held] if held else [])


def document_frequency(texts: DataFrame, vocabulary: frozenset[bytes]) -> DataFrame:
    """(term, df) of the vocabulary's terms over all documents; summed in each slice before the shuffle."""
    def count(cols: dict[str, list]) -> dict[str, list]:
        n: dict[bytes, int] = defaultdict(int)
        for t in cols["text"]:
            for w in vocabulary.intersection(fold_words(t)):
                n[w] += 1
        return {"term": list(n), "df": list(n.values())}

    return mapped(texts.select("text"), count, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))


def seeds(items: list[tuple[str, list[bytes]]], df: dict[bytes, int], span: int, terms_per_window: int) -> list[tuple[bytes, int, int, int, int]]:
    """(term, item number, position in the item, first and last window using it) of the rarest terms of each window."""
    out = []
    for k, (_, words) in enumerate(items):
        n = min(span, len(words))
        used: dict[int, list[int]] = defaultdict(list)
        for start in range(len(words) - n + 1):
            if any(w not in df for w in words[start:start + n]):
                continue  # a word that no document has
            rank = sorted(range(start, start + n), key=lambda i: (df[words[i]], i))
            for i in rank[:terms_per_window]:
                used[i].append(start)
        out += [(words[i], k, i, s) for i, starts in used.items() for s in starts]
    return out


def near_seeds(items: list[tuple[str, list[bytes]]], df: dict[bytes, int], span: int, near_terms: int, near_least: int) -> list[tuple[bytes, int, int, int]]:
    """(term, item number, position in the item, window) of the rarest different terms of each window; words that no document has are passed over."""
    out = []
    for k, (_, words) in enumerate(items):
        n = min(span, len(words))
        for start in range(len(words) - n + 1) if n >= near_terms else ():
            first: dict[bytes, int] = {}
            for i in range(start, start + n):
                if words[i] in df:
                    first.setdefault(words[i], i)
            chosen = sorted(first.values(), key=lambda i: (df[words[i]], i))[:near_terms]
            if len(chosen) >= near_least:
                out += [(words[i], k, i, start) for i in chosen]
    return out


def build_index(texts: DataFrame, terms: frozenset[bytes]) -> DataFrame:
    """Positional postings (term, rid, pos) of the given terms over all documents."""
    def post(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"term": [], "rid": [], "pos": []}
        for rid, t in zip(cols["rid"], cols["text"], strict=True):
            words = fold_words(t)
            if terms.isdisjoint(words):
                continue
            for p, w in enumerate(words):
                if w in terms:
                    out["term"].append(w)
                    out["rid"].append(rid)
                    out["pos"].append(p)
        return out

    return mapped(texts.select("rid", "text"), post, "term binary, rid long, pos int")


def candidates(index: DataFrame, wanted: DataFrame, terms_per_window: int, n_terms: DataFrame) -> DataFrame:
    """(rid, item, start, diagonal) of windows whose chosen terms all lie on one diagonal of the document."""
    return (index.join(wanted, "term")
            .select("rid", "item", "start", (F.col("pos") - F.col("at")).alias("diagonal"), "at").distinct()
            .groupBy("rid", "item", "start", "diagonal").agg(F.count("*").alias("n"))
            .join(n_terms, ["item", "start"]).where("n = n_terms").select("rid", "item", "start", "diagonal"))


def proximity(index: DataFrame, wanted: DataFrame, slack: int, at_least: int) -> DataFrame:
    """(rid, item, start, n_terms): documents where ``at_least`` chosen terms of a window lie within ``slack`` words of the phrase's places."""
    on = [c for c in ("term", "item", "at") if c in index.columns]  # an index may be narrowed to items and their places
    rows = index.join(wanted, on).select("rid", "item", "start", (F.col("pos") - F.col("at")).alias("diagonal"), "at").distinct()
    near = Window.partitionBy("rid", "item", "start").orderBy("diagonal").rangeBetween(0, slack)
    return (rows.withColumn("n", F.size(F.collect_set("at").over(near))).groupBy("rid", "item", "start")
            .agg(F.max("n").alias("n_terms")).where(F.col("n_terms") >= at_least))


def near_matches(index: DataFrame, near: DataFrame, slack: int, at_least: int) -> DataFrame:
    """(rid, item) of proximity matches; documents with too few of an item's terms go before the windows are spread out."""
    places = near.select("term", "item", "at").distinct()
    some = (index.select("rid", "term").distinct().join(places.select("term", "item").distinct(), "term")
            .groupBy("rid", "item").agg(F.count("*").alias("n")).where(F.col("n") >= at_least).select("rid", "item"))
    kept = stage(index.join(places, "term").join(some, ["rid", "item"]).select("rid", "term", "pos", "item", "at"), "decontam-near")
    return proximity(kept, near, slack, at_least).select("rid", "item").distinct()


def contamination(docs: DataFrame, bench: DataFrame, *, text: str = "text", id_cols: tuple[str, ...] = ("doc_id",), item_id: str = "item_id",
                  item_text: str = "text", span: int = SPAN, terms_per_window: int = 3, block_words: int = 2_000_000, per_hits: int = 20,
                  near: bool = False, near_terms: int = 5, near_least: int = 4, slack: int = 2) -> DataFrame:
    """Per document: ``id_cols``, ``rid``, n_words, n_hit, n_items, items_sha256, contaminated; with ``near`` also n_near and near_items.

    ``near_items`` are the ids of items with a proximity match (exact ones among them), n_near their number.
    ``rid`` is a hash of the row's id columns and text; rows alike in them are judged alike.
    """
    spark = docs.sparkSession
    texts = docs.select(*[docs[c] for c in id_cols], F.xxhash64(*[docs[c] for c in id_cols], docs[text]).alias("rid"), text_bytes(docs[text]).alias("text"))
    found: DataFrame | None = None
    nearly: DataFrame | None = None
    for items in _item_blocks(bench, item_id, item_text, block_words):
        vocabulary = frozenset(w for _, words in items for w in words)
        df = {bytes(r["term"]): r["df"] for r in document_frequency(texts, vocabulary).toLocalIterator()}  # no more than the block's words
        wanted = seeds(items, df, span, terms_per_window)
        loose = near_seeds(items, df, span, near_terms, near_least) if near else []
        if not wanted and not loose:
            continue
        index = stage(build_index(texts, frozenset(w[0] for w in [*wanted, *loose])), "decontam-index")
        if loose:
            near_rows = spark.createDataFrame([(bytearray(t), k, i, s) for t, k, i, s in loose], "term binary, item int, at int, start int")
            ids = spark.createDataFrame([(k, name) for k, (name, _) in enumerate(items)], "item int, name string")
            named = near_matches(index, near_rows, slack, near_least).join(ids, "item").select("rid", "name")
            nearly = named if nearly is None else nearly.unionByName(named)
        if not wanted:
            continue
        seed_rows = spark.createDataFrame([(bytearray(t), k, i, s) for t, k, i, s in wanted], "term binary, item int, at int, start int")
        n_terms = seed_rows.groupBy("item", "start").agg(F.count("*").alias("n_terms"))
        suspects = stage(candidates(index, seed_rows, terms_per_window, n_terms).select("rid", "item").distinct(), "decontam-found")
        here = suspects.groupBy("rid").agg(F.collect_list("item").alias("items"))

        phrases_of: list[tuple[str | None, dict[tuple[bytes, ...], None]]] = []
        for name, words in items:
            n = min(span, len(words))
            phrases_of.append((name, dict.fromkeys(tuple(words[i:i + n]) for i in range(len(words) - n + 1))))

        def compare(cols: dict[str, list], phrases_of=phrases_of) -> dict[str, list]:
            out: dict[str, list] = {"rid": [], "hit": [], "found": []}
            for rid, t, ks in zip(cols["rid"], cols["text"], cols["items"], strict=True):
                words, phrases = fold_words(t), defaultdict(list)
                for k in ks:
                    for p in phrases_of[k][1]:
                        phrases[p].append(phrases_of[k][0])
                cover, names = bytearray(len(words)), set()
                for n in sorted({len(p) for p in phrases}):
                    for i in range(len(words) - n + 1):
                        ids = phrases.get(tuple(words[i:i + n]))
                        if ids:
                            names.update(ids)
                            cover[i:i + n] = b"\1" * n
                if names:
                    out["rid"].append(rid)
                    out["hit"].append([i for i, c in enumerate(cover) if c])
                    out["found"].append(list(names))
            return out

        hits = mapped(texts.select("rid", "text").join(here, "rid"), compare, "rid long, hit array<int>, found array<string>").dropDuplicates(["rid"])
        found = hits if found is None else found.unionByName(hits)

    def size(cols: dict[str, list]) -> dict[str, list]:
        return {c: cols[c] for c in (*id_cols, "rid")} | {"n_words": [len(fold_words(t)) for t in cols["text"]]}

    types = dict(texts.dtypes)
    out = mapped(texts, size, ", ".join(f"`{c}` {types[c]}" for c in (*id_cols, "rid")) + ", n_words long")
    if found is None:
        out = out.withColumns({"hit": F.array().cast("array<int>"), "found": F.array().cast("array<string>")})
    else:
        found = found.groupBy("rid").agg(F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"), F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))
        out = out.join(stage(found, "decontam-hits"), "rid", "left")
    names = F.array_sort(F.coalesce("found", F.array().cast("array<string>")))
    if near:
        if nearly is None:
            out = out.withColumns({"near_items": F.array().cast("array<string>"), "n_near": F.lit(0).cast("long")})
        else:
            by_rid = nearly.groupBy("rid").agg(F.array_sort(F.collect_set("name")).alias("near_items"), F.max(F.col("name").isNull().cast("int")).alias("unnamed"))
            out = (out.join(stage(by_rid, "decontam-nearly"), "rid", "left").withColumn("near_items", F.coalesce("near_items", F.array().cast("array<string>")))
                   .withColumn("n_near", (F.size("near_items") + F.coalesce("unnamed", F.lit(0))).cast("long")))
        extra = ["n_near", "near_items"]
    else:
        extra = []
    return (out.withColumn("n_hit", F.when(F.col("hit").isNull(), 0).otherwise(F.size("hit")).cast("long"))
            .withColumn("n_items", F.size(names).cast("long")).withColumn("items_sha256", F.sha2(F.array_join(names, ","), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (per_hits * F.col("n_hit") >= F.col("n_words")))
            .select(*[F.col(f"`{c}`") for c in id_cols], "rid", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", *extra))


def clean(docs: DataFrame, bench: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that are not contaminated, in their own columns."""
    bad = contamination(docs, bench, text=text, id_cols=(doc_id,)).where("contaminated").select("rid").distinct()
    return docs.join(bad, F.xxhash64(docs[doc_id], docs[text]) == bad["rid"], "left_anti")
