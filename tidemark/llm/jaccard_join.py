"""N-gram Jaccard join (5): MinHash banding, exact verification on full shingle sets.

Shingles are five consecutive words ``[^\\x20\\x09-\\x0D]+`` (all words of a shorter text);
two documents are linked when the Jaccard similarity of their shingle sets is 0.8 or more.
Bands and rows are chosen for a target recall at that similarity (0.9999: 24 bands of 5 rows).

1. One pass signs every text. Texts with equal shingle sets are one *copy class*, reduced map-side.
2. The classes' band hashes are shuffled; band values held by one class only are dropped.
3. A bucket is dealt into units of bounded size: its members go to blocks, and each unit compares two blocks, so no
   task holds a large bucket and no pairs are written. A first pass over units (sketches, 240 bytes a class)
   keeps the members with a pair that may be similar: a pair counts in the first band it shares only, so a pair is compared once.
4. Only for those members the texts are read again; units compare their whole shingle sets (a matrix
   product of bounded size) and return for each member its number of links and the least member it is connected to.
5. Connected components of these edges (large star, small star; a written table each round) are the classes.

Every row gets ``class_id`` (least doc_id of its component), ``copy_class`` (least doc_id with an equal
shingle set) and ``n_links`` (other documents it is linked with, copies included).

Defined results: null, empty and wordless texts have no shingles and are linked with nothing;
repeated rows are copies; ties are broken by the least doc_id, null first; an empty table gives an empty
result; other columns are ignored or carried.

Cost in a group of different texts that are all alike: the exact number of links needs their pairs, so step 4 takes time (not
rows or memory) with the square of the *distinct* texts of one bucket, evenly dealt over units.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, choose_bands, gram_hashes, grouped, mapped, mix64, ship, signed, stage, text_bytes

ship(__name__)

SHINGLE = 5
SIMILARITY = (4, 5)  # as a fraction, so that comparisons are exact
UNIT_SHINGLES = 1 << 18
UNIT_MEMBERS = 1 << 10


def shingle_set(words: list[bytes], known: WordHashes) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(known.of(words), min(SHINGLE, len(words))))


class Signer:
    """MinHash values of a shingle set: one function for each of bands x rows."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 2**63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, bands * rows, np.uint64)

    def sign(self, grams: np.ndarray) -> np.ndarray:
        best = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(grams), 2048):
            part = grams[None, at:at + 2048] * self.a[:, None] + self.b[:, None]
            best = np.minimum(best, part.min(axis=1))
        return best

    def band_hashes(self, signature: np.ndarray) -> np.ndarray:
        out = np.arange(1, self.bands + 1, dtype=np.uint64)
        for column in signature.reshape(self.bands, self.rows).T:
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + column)
        return out

    @staticmethod
    def sketch(signature: np.ndarray) -> bytes:
        return (mix64(signature) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _first_common(bands: np.ndarray, bucket: int, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Of pairs that share ``bucket``: whether they share no earlier band."""
    band = int(np.flatnonzero((bands == bucket).all(axis=0))[0])
    earlier = np.zeros((len(rows), len(cols)), bool)
    for k in range(band):
        earlier |= bands[rows, k][:, None] == bands[cols, k][None, :]
    return ~earlier


def _sides(i: int, j: int, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members that a unit compares: one block with itself, or two blocks."""
    every = np.arange(len(block))
    return (every, every) if i == j else (np.flatnonzero(block == i), np.flatnonzero(block == j))


def _screen(least: float):
    def fn(g: dict[str, list]) -> dict[str, list] | None:
        i, j, bucket = g["i"][0], g["j"][0], g["bucket"][0]
        rows, cols = _sides(i, j, np.array(g["block"]))
        if not len(rows) or not len(cols) or len(g["rep"]) < 2:
            return None
        bands = np.array(g["bands"], np.int64)
        sketch = np.frombuffer(b"".join(g["sketch"]), "<u2").reshape(len(bands), -1)
        same = np.zeros((len(rows), len(cols)), np.int32)
        for k in range(sketch.shape[1]):
            same += sketch[rows, k][:, None] == sketch[cols, k][None, :]
        ok = (same >= least * sketch.shape[1]) & _first_common(bands, bucket, rows, cols)
        if i == j:
            np.fill_diagonal(ok, False)
        keep = sorted({*rows[ok.any(axis=1)].tolist(), *cols[ok.any(axis=0)].tolist()})
        return {n: [g[n][k] for k in keep] for n in ("bucket", "i", "j", "block", "rep")} if keep else None

    return fn


def _overlaps(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Sizes of the intersections, by a matrix product over the shingles held by two or more members."""
    _, back, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    width = int(shared[-1]) + 1 if len(shared) else 0
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    live = count[back] > 1
    owner, place = owner[live], shared[back[live]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(rows), len(cols)), np.float32)
    step = max(256, (1 << 22) // max(1, len(sets)))
    for at in range(0, width, step):
        lo, hi = np.searchsorted(place, (at, at + step))
        m = np.zeros((len(sets), min(step, width - at)), np.float32)
        m[owner[lo:hi], place[lo:hi] - at] = 1
        out += m[rows] @ m[cols].T
    return out.astype(np.int64)


def _verify(g: dict[str, list]) -> dict[str, list] | None:
    i, j, bucket = g["i"][0], g["j"][0], g["bucket"][0]
    rows, cols = _sides(i, j, np.array(g["block"]))
    if not len(rows) or not len(cols) or len(g["rep"]) < 2:
        return None
    sets = [np.frombuffer(x, np.uint64) for x in g["grams"]]
    size = np.array([len(s) for s in sets])
    inter = _overlaps(sets, rows, cols)
    union = size[rows][:, None] + size[cols][None, :] - inter
    linked = (inter * SIMILARITY[1] >= union * SIMILARITY[0]) & _first_common(np.array(g["bands"], np.int64), bucket, rows, cols)
    if i == j:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return None
    mult, links = np.array(g["mult"], np.int64), np.zeros(len(sets), np.int64)
    links[rows] += linked.astype(np.int64) @ mult[cols]
    if i != j:
        links[cols] += linked.T.astype(np.int64) @ mult[rows]
    reps = np.array(g["rep"], np.int64)
    label = reps.copy()
    while True:  # the least member of each component of the unit
        top = np.iinfo(np.int64).max
        new = label.copy()
        new[rows] = np.minimum(new[rows], np.where(linked, label[cols][None, :], top).min(axis=1))
        new[cols] = np.minimum(new[cols], np.where(linked, label[rows][:, None], top).min(axis=0))
        if (new == label).all():
            break
        label = new
    live = np.flatnonzero(links)
    return {"rep": reps[live].tolist(), "links": links[live].tolist(), "root": label[live].tolist()}


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component of ``edges`` (a, b); single nodes are left out.

    Large star and small star in turn until nothing changes; each round is written to the shared folder.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    state = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        edges = stage(small, "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def _classes(docs: DataFrame, text: str, doc_id: str, recall: float, max_hashes: int, unit_shingles: int, unit_members: int) -> tuple[DataFrame, DataFrame]:
    """Signed rows (rid, doc_id, k1, k2), and the copy classes with their component and links."""
    bands, rows = choose_bands(SIMILARITY[0] / SIMILARITY[1], recall, max_hashes)

    def sign(cols: dict[str, list]) -> dict[str, list]:
        signer, known = Signer(bands, rows), WordHashes()
        out: dict[str, list] = {"rid": cols["rid"], "doc_id": cols["doc_id"], "k1": [], "k2": [], "n": [], "bands": [], "sketch": []}
        for t in cols["text"]:
            grams = shingle_set(t.split(), known)
            k = xxhash.xxh3_128_intdigest(grams.tobytes())
            out["k1"].append((k >> 64) - 2**63)
            out["k2"].append((k & 2**64 - 1) - 2**63)
            out["n"].append(len(grams))
            s = signer.sign(grams) if len(grams) else None
            out["bands"].append([] if s is None else signed(signer.band_hashes(s)).tolist())
            out["sketch"].append(b"" if s is None else signer.sketch(s))
        return out

    def sets(cols: dict[str, list]) -> dict[str, list]:
        known = WordHashes()
        return {"rep": cols["rid"], "grams": [shingle_set(t.split(), known).tobytes() for t in cols["text"]]}

    rid = F.xxhash64(docs[doc_id], docs[text]).alias("rid")
    kind = dict(docs.dtypes)[doc_id]
    texts = docs.select(rid, docs[doc_id].alias("doc_id"), text_bytes(docs[text]).alias("text"))
    signed_rows = stage(mapped(texts, sign, f"rid long, doc_id {kind}, k1 long, k2 long, n int, bands array<long>, sketch binary", rows=2048), "jaccard-signed")
    classes = stage(signed_rows.where("n > 0").groupBy("k1", "k2").agg(
        F.min("rid").alias("rep"), F.count("*").alias("mult"), F.first("n").alias("n"), F.min(F.struct("doc_id", "rid")).alias("first"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "jaccard-classes")

    member = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    # Written, so that AQE can split the members of a hot bucket in the join below.
    full = stage(member.groupBy("bucket").agg(F.count("*").alias("m"), F.sum("n").alias("total")).where("m > 1"), "jaccard-buckets")
    blocks = F.greatest(F.ceil(F.col("total") / unit_shingles), F.ceil(F.col("m") / unit_members)).cast("long")
    unit = (member.join(full, "bucket").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep", "bucket"), "blocks"))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("rep", "bucket", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    screened = stage(grouped(unit.join(classes.select("rep", "bands", "sketch"), "rep"), ["bucket", "i", "j"], _screen(SIMILARITY[0] / SIMILARITY[1] - 0.2),
                             "bucket long, i long, j long, block long, rep long"), "jaccard-screened")
    wanted = screened.select(F.col("rep").alias("rid")).distinct()
    # The wanted rows follow the corpus in size, so they are not broadcast, however few they are here: one plan at every size.
    grams = mapped(texts.select("rid", "text").join(wanted.hint("merge"), "rid").dropDuplicates(["rid"]), sets, "rep long, grams binary")
    checked = stage(grouped(screened.join(classes.select("rep", "mult", "bands"), "rep").join(grams, "rep"), ["bucket", "i", "j"], _verify,
                            "rep long, links long, root long"), "jaccard-links")
    label = components(checked.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = (classes.select("k1", "k2", "rep", "mult", "first").join(label.withColumnRenamed("node", "rep"), "rep", "left").join(links, "rep", "left")
               .withColumn("root", F.coalesce("root", "rep"))
               .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("mult") - 1).drop("links"))
    classes = stage(classes.join(classes.groupBy("root").agg(F.min("first").alias("kept")), "root"), "jaccard-labels")
    return signed_rows.select("rid", "doc_id", "k1", "k2", "n"), classes


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, recall: float = 0.9999, max_hashes: int = 128,
                    unit_shingles: int = UNIT_SHINGLES, unit_members: int = UNIT_MEMBERS) -> DataFrame:
    """(doc_id, class_id, copy_class, n_links) of every row."""
    rows, classes = _classes(docs, text, doc_id, recall, max_hashes, unit_shingles, unit_members)
    return (rows.join(classes.select("k1", "k2", "first", "kept", "n_links"), ["k1", "k2"], "left")
            .select("doc_id", F.when(F.col("kept").isNull(), F.col("doc_id")).otherwise(F.col("kept.doc_id")).alias("class_id"),
                    F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("copy_class"),
                    F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")))


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **limits) -> DataFrame:
    """The documents with the least doc_id of each class, in their own columns; those without words stay too (once for each doc_id)."""
    rows, classes = _classes(docs, text, doc_id, limits.pop("recall", 0.9999), limits.pop("max_hashes", 128),
                             limits.pop("unit_shingles", UNIT_SHINGLES), limits.pop("unit_members", UNIT_MEMBERS))
    stay = classes.select(F.col("kept.rid").alias("rid")).unionByName(rows.where("n = 0").select("rid")).distinct()
    name = "rid"
    while name in docs.columns:
        name += "_"
    return (docs.withColumn(name, F.xxhash64(docs[doc_id], docs[text])).join(stay.withColumnRenamed("rid", name), name, "left_semi")
            .dropDuplicates([name]).drop(name))
