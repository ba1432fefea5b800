"""Token-ID output (1): one concatenated id array in segments, document boundaries in Elias-Fano code.

File format (Parquet, a row for each segment, written and committed by Spark):

* ``part``, ``seg``     the write task and the segment's number in it; their order is the order of documents
* ``part_start``        ids before the segment in its part
* ``doc_id``            the segment's document ids, ascending
* ``ids``               its ids, concatenated, little-endian, ``width`` bytes each (2 while the vocabulary fits)
* ``n_docs, n_ids, low_bits, low, high, samples``   the ends of the documents in Elias-Fano code: the low bits
  packed, the high bits in unary, and the place of every 64th set bit of ``high`` (32 bits each) for ``select``

``select(i)`` gives the end of document i from a sample, at most a few words of the bit string, and the low
bits: no table of 64-bit offsets is written.  A small table ``parts`` (ids and documents in each part) gives the parts' starts.

Defined results: null text is empty and has only the end id; rows with one doc_id lie side by side, ordered by a hash of
the text; a null doc_id sorts first; a very long document makes a segment of its own; an empty table gives no segments.

The texts are range-partitioned by document id before they are encoded, so they are shuffled once and the ids never; a task holds
one segment.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import mapped, ship, stage, text_bytes

ship(__name__)

SAMPLE = 64
SEGMENT = ("part int, seg int, part_start long, doc_id array<long>, ids binary, width int, n_docs int, n_ids long, "
           "low_bits int, low binary, high binary, samples binary")


def elias_fano(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """(low_bits, low, high, samples) of a non-decreasing array of non-negative integers."""
    n = len(ends)
    bits = max(0, int(ends[-1] // n).bit_length() - 1) if n else 0
    ends = ends.astype(np.uint64)
    low = ((ends[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).reshape(-1)
    ones = (ends >> np.uint64(bits)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    high[ones] = 1
    pack = lambda x: np.packbits(x, bitorder="little").tobytes()
    return bits, pack(low), pack(high), ones[::SAMPLE].astype("<u4").tobytes()


class Boundaries:
    """Reads the code: ``select(i)`` for one document, ``all()`` for a whole segment."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.bits, self.low, self.high = n, low_bits, low, high
        self.samples = np.frombuffer(samples, "<u4")

    def _low(self, i: int) -> int:
        at = i * self.bits
        return int.from_bytes(self.low[at // 8:(at + self.bits + 7) // 8], "little") >> at % 8 & (1 << self.bits) - 1

    def select(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        rest = self.high[byte] >> at % 8 << at % 8  # the sampled bit is the first one left
        while (here := rest.bit_count()) <= left:
            left -= here
            byte += 1
            rest = self.high[byte]
        for _ in range(left):
            rest &= rest - 1
        one = byte * 8 + (rest & -rest).bit_length() - 1
        return one - i << self.bits | self._low(i)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)) << self.bits
        if self.bits:
            low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[:self.n * self.bits].reshape(self.n, self.bits)
            out = out + low.astype(np.int64) @ (1 << np.arange(self.bits, dtype=np.int64))
        return out


def _stems(runs: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Each run in lower case without its closing mark, and the mark (0, 1 or 2: none, full stop, comma): the tokenizer lower-cases, and a mark
    after an ASCII letter or digit is a token of its own."""
    at = np.frombuffer(runs.buffers()[1], np.int32)[runs.offset:runs.offset + len(runs) + 1] if len(runs) else np.zeros(1, np.int32)
    data = np.frombuffer(runs.buffers()[2] or b"", np.uint8)
    long = np.flatnonzero(np.diff(at) > 1)
    last, alnum = data[at[long + 1] - 1], _ALNUM[data[at[long + 1] - 2]]
    mark = np.zeros(len(runs), np.int8)
    mark[long] = np.where(alnum, (last == ord(".")) + 2 * (last == ord(",")), 0)
    keep = np.ones(len(data), bool)
    keep[at[1:][mark > 0] - 1] = False
    offsets = at - np.concatenate(([0], np.cumsum(mark > 0))).astype(np.int32) - at[0]
    stems = pa.Array.from_buffers(pa.string(), len(runs), [None, pa.py_buffer(offsets), pa.py_buffer(data[at[0]:at[-1]][keep[at[0]:at[-1]]])])
    return pc.if_else(pc.match_substring(stems, "<"), stems, pc.ascii_lower(stems)), mark


_ALNUM = np.array([bytes([i]).isalnum() for i in range(256)])
#: Runs that are one word of the tokenizer whatever stands around them: letters that normalisation leaves as they are.
_LETTERS = "^[a-zß-öø-ÿ]+$"
#: A text on which runs must give the ids of the whole.
_PROBE = "The quick BROWN fox. 12.5 a-b, it's «Él» x,\ty\n z. <|tag|> naïve"


class Codes:
    """Ids of numbered words: words, ends and ids in one array each, so a word takes a few bytes more than its own."""

    def __init__(self, dtype: str):
        self.words, self.ends, self.ids = pa.array([], pa.string()), np.zeros(1, np.int64), np.empty(0, dtype)

    def add(self, words: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes)))
        self.ids = np.concatenate((self.ids, ids))

    def numbers(self, words: pa.Array) -> np.ndarray:
        """-1 for those without a number."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _gather(ends: np.ndarray, ids: np.ndarray, numbers: np.ndarray, step: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """(how many ids each numbered word has, all their ids); ``step`` words at a time, as the places take more memory than the ids."""
    sizes = np.diff(ends)[numbers]
    out = [ids[:0]]
    for k in range(0, len(numbers), step):
        n, starts = sizes[k:k + step], ends[numbers[k:k + step]]
        to = np.cumsum(n)
        out.append(ids[np.repeat(starts - (to - n), n) + np.arange(to[-1])])
    return sizes, np.concatenate(out)


class ChunkEncoder:
    """Ids of a text by the tokenizer, remembered for each run of characters between ASCII white space.

    Only for tokenizers that drop white space, never join across it, and lower-case: a probe text is compared, and ``tests/llm`` holds whole
    texts against it.  Texts are cut into runs, and runs and their stems numbered, by Arrow; new stems of plain letters are encoded many at a time,
    which the mark of a word's last token takes apart again.  The memory is bounded: at ``limit`` stems or ``limit_bytes`` bytes of them it starts anew.
    """

    def __init__(self, path: str, dtype: str, limit: int = 800_000, limit_bytes: int = 32 << 20):
        from tokenizers import Tokenizer

        self.tok, self.dtype, self.limit, self.limit_bytes = Tokenizer.from_file(path), dtype, limit, limit_bytes
        self.letters = self._letters_only(path)
        self.last = np.zeros(self.tok.get_vocab_size(), bool)
        self.last[[i for t, i in self.tok.get_vocab().items() if t.endswith("</w>")]] = True
        self._forget()
        whole = self.tok.encode(_PROBE, add_special_tokens=False).ids
        if np.frombuffer(self.encode([_PROBE.encode()])[0], dtype).tolist() != whole:
            raise ValueError("the tokenizer doesn't treat runs between white space on their own, in lower case")

    def _letters_only(self, path: str):
        """The tokenizer without its normalisation and its splitting rules, which change nothing in words of plain letters between blanks (or the
        whole tokenizer, should it differ on some)."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        short = Tokenizer.from_file(path)
        short.normalizer = normalizers.Sequence([])
        short.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        probe = "the quick brown fox straße éléphant ñandú øre ça zzyzx ÿ"
        return short if short.encode(probe, add_special_tokens=False).ids == self.tok.encode(probe, add_special_tokens=False).ids else self.tok

    def _forget(self) -> None:
        self.known, self.held = Codes(self.dtype), 0
        self._learn(pa.array(["", ".", ","]))  # the numbers of _stems' marks

    def _learn(self, words: pa.Array) -> np.ndarray:
        """The numbers of new words."""
        letters = pc.match_substring_regex(words, _LETTERS).to_numpy(zero_copy_only=False) & self.last.any()
        order, sizes, found = [], [], []
        simple = np.flatnonzero(letters)
        for at in range(0, len(simple), 512):
            part = simple[at:at + 512]
            ids = np.array(self.letters.encode_batch_fast([" ".join(words.take(part).to_pylist())], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                order.append(part)
                sizes.append(np.diff(ends, prepend=0))
                found.append(ids)
            else:
                letters[part] = False
        rest = np.flatnonzero(~letters)
        for at in range(0, len(rest), 4096):
            part = rest[at:at + 4096]
            texts = [w.decode("utf-8", "replace") for w in words.take(part).view(pa.binary()).to_pylist()]
            ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            order.append(part)
            sizes.append(np.array([len(x) for x in ids], np.int64))
            found.append(np.array([i for x in ids for i in x], self.dtype))
        places, numbers = np.concatenate(order), np.empty(len(words), np.int64)
        numbers[places] = np.arange(len(self.known.words), len(self.known.words) + len(words))
        learnt = words.take(places)
        self.known.add(learnt, np.concatenate(sizes), np.concatenate(found))
        self.held += pc.sum(pc.binary_length(learnt)).as_py()
        return numbers

    def encode(self, texts: list[bytes] | pa.Array) -> list[bytes]:
        if len(self.known.words) >= self.limit or self.held >= self.limit_bytes:
            self._forget()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
        runs = pc.ascii_split_whitespace(texts.view(pa.string()))  # bytes are only looked at for white space
        coded = runs.flatten().dictionary_encode()
        stems, marks = _stems(coded.dictionary)
        stems = stems.dictionary_encode()
        numbers = self.known.numbers(stems.dictionary)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = self._learn(stems.dictionary.take(new))
        pairs = np.stack((numbers[stems.indices.to_numpy()], marks), axis=1).reshape(-1)
        sizes, ids = _gather(self.known.ends, self.known.ids, pairs)
        ends = np.concatenate(([0], np.cumsum(sizes.reshape(-1, 2).sum(axis=1))))
        sizes, ids = _gather(ends, ids, coded.indices.to_numpy())
        ends = np.concatenate(([0], np.cumsum(sizes)))
        bounds = ends[runs.offsets.to_numpy() - runs.offsets[0].as_py()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]


def _kept_encoder(path: str, dtype: str) -> ChunkEncoder:
    """The encoder of this Python worker (one at most), kept with its words for the tasks that follow: most words of a task come again in the next,
    and loading the tokenizer takes a tenth of a task's time."""
    kept = sys.modules.setdefault("_tidemark_kept_encoder", types.ModuleType("_tidemark_kept_encoder"))
    if getattr(kept, "key", None) != (path, dtype):
        kept.key, kept.encoder = None, None
        kept.encoder = ChunkEncoder(path, dtype)
        kept.key = (path, dtype)
    return kept.encoder


def _slices(texts: pa.Array, size: int = 8 << 20, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Stretches of at most ``rows`` texts that end once they hold ``size`` bytes."""
    length = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(length.tolist(), 1):
        held += n
        if held >= size or i - start >= rows or i == len(length):
            yield start, i
            start, held = i, 0


def write_store(docs: DataFrame, tokenizer: str, *, text: str = "text", doc_id: str = "doc_id", end_id: int = 1, vocabulary: int = 49_408,
                segment_ids: int = 1 << 20) -> DataFrame:
    """Encode, write the segments to the shared folder, and return them as read back."""
    width = 2 if vocabulary <= 1 << 16 else 4
    dtype = f"<u{width}"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(SEGMENT))
    end = np.array([end_id], dtype).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder = _kept_encoder(tokenizer, dtype)
        part, seg, before = TaskContext.get().partitionId(), 0, 0
        names: list = []
        held: list[bytes] = []
        size = 0

        def segment() -> pa.RecordBatch:
            ends = np.cumsum([len(x) // width for x in held])
            bits, low, high, samples = elias_fano(ends)
            row = (part, seg, before, list(names), b"".join(held), width, len(held), size, bits, low, high, samples)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for at, to in _slices(batch.column(1)):
                cols = batch.slice(at, to - at)
                for name, ids in zip(cols.column(0).to_pylist(), coder.encode(cols.column(1)), strict=True):
                    n = len(ids) // width + 1
                    if held and size + n > segment_ids:
                        yield segment()
                        seg, before, size = seg + 1, before + size, 0
                        names, held = [], []
                    names.append(name)
                    held.append(ids + end)
                    size += n
        if held:
            yield segment()

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), text_bytes(docs[text]).alias("text"), F.xxhash64(docs[text]).alias("tie"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
    return stage(ordered.select("doc_id", "text").mapInArrow(encode, SEGMENT), "token-store")


def parts(store: DataFrame) -> DataFrame:
    """(part, start, n_ids, n_docs): a row for each write task, whose number bounds the window."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (store.groupBy("part").agg(F.sum("n_ids").alias("n_ids"), F.sum("n_docs").alias("n_docs"))
            .withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))))


def read_documents(store: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the written segments."""
    def read(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"part": [], "doc_id": [], "in_part": [], "n_tokens": [], "ids_crc32": []}
        for k, names in enumerate(cols["doc_id"]):
            ends = Boundaries(cols["n_docs"][k], cols["low_bits"][k], cols["low"][k], cols["high"][k], cols["samples"][k]).all().tolist()
            ids = np.frombuffer(cols["ids"][k], f"<u{cols['width'][k]}").astype("<u4")
            start = 0
            for name, stop in zip(names, ends, strict=True):
                out["part"].append(cols["part"][k])
                out["doc_id"].append(name)
                out["in_part"].append(cols["part_start"][k] + start)
                out["n_tokens"].append(stop - start)
                out["ids_crc32"].append(zlib.crc32(ids[start:stop]))
                start = stop
        return out

    rows = mapped(store, read, "part int, doc_id long, in_part long, n_tokens long, ids_crc32 long", rows=1)
    return (rows.join(parts(store).select("part", F.col("start").alias("part_at")), "part")
            .select("doc_id", (F.col("part_at") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32"))


def read_document(store: DataFrame, doc_id: int) -> DataFrame:
    """(doc_id, ids) of one document (a row for each of its copies): its segment's boundaries are read by ``select``, not as a whole."""
    def read(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": [], "ids": []}
        for k, names in enumerate(cols["doc_id"]):
            ends = Boundaries(cols["n_docs"][k], cols["low_bits"][k], cols["low"][k], cols["high"][k], cols["samples"][k])
            width = cols["width"][k]
            for i, name in enumerate(names):
                if name == doc_id:
                    a, b = (ends.select(i - 1) if i else 0) * width, ends.select(i) * width
                    out["doc_id"].append(name)
                    out["ids"].append(np.frombuffer(cols["ids"][k][a:b], f"<u{width}").astype(np.int64).tolist())
        return out

    return mapped(store.where(F.array_contains("doc_id", F.lit(doc_id).cast("long"))), read, "doc_id long, ids array<long>", rows=1)
