"""LM scoring (13): subword lattice likelihood.

Texts are lower-cased (A-Z), split into words and closed by one end token.  A word's probability is the sum over all its
segmentations, each the product of its arcs' scores:

* arcs over the pieces of an existing vocabulary (a given file), summed by a forward recursion in log space over byte places,
  all[j] = logsumexp over pieces i..j of all[i] + log p(piece); a word is its bytes after a space, pieces lie inside words, and
  every single byte is a piece, so that any text has a probability;
* one arc over the whole word, if training texts hold it, with its discounted share (c - D) / N of the N training tokens.

The discounts of the V training words, D V / N, are the weight of the pieces' sum; the end has the share of the training texts.  These
sum to one over words and end, so the probabilities of all texts sum to one.  Pieces with A-Z can't occur and are left out.  First weights
follow from the file's scores; ``rounds`` of expectation maximisation over the distinct training words (each once, as the weight D V / N
has it) fit them by the expected uses of each piece over all segmentations.  D is n1 / (n1 + 2 n2), from the words that occur once and
twice.  ``base`` is a word unigram model with add-one smoothing; it charges an unknown word nothing for its spelling, as a probability of texts must.

Defined results: null and empty texts have the end token only; a null id is in training; repeated rows count as often as they occur;
an empty table gives an empty result; without training texts pieces and end weigh one half each; other columns
are not read, whatever their names.

Plan: words don't depend on each other, so the recursion is done once for each distinct word of the corpus and a text sums its
tokens.  One Python pass packs texts into blocks of ``BLOCK_BYTES``: a row for each distinct word of a block with its training count, and a row for
each text with numbers into them.  Word rows are shuffled once by word, which gives its count and its places in blocks; a word has
one row a block, so the most frequent one is a tiny share of the rows.  Scores go back packed by block and meet the
texts there.  The driver gets totals and sums by piece (bounded by the vocabulary); everything else is in tables in the shared folder.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _arrow_schema, ship, stage, text_bytes

ship(__name__)

#: Bytes of text after which a block is closed; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
ROUNDS = 2
#: Added to each piece's expected uses, so that pieces without any keep a probability.
SMOOTHING = 0.01
#: Words of more bytes are scored one at a time, by the same recursion.
LONG = 64
#: Bits of a word's number within its block; a place is block << NUMBER_BITS | number.
NUMBER_BITS = 28
#: Places in one row of a word, and words that are scored at a time.
PLACES, WORDS = 1 << 16, 50_000
_SLOTS = 20
_BASE = 0x9E3779B97F4A7C15


# --------------------------------------------------------------------------- the vocabulary

def read_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """(pieces, scores) of a SentencePiece model file: bytes, a space standing for the word start; one piece for each string."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    best: dict[bytes, float] = {bytes([b]): -math.inf for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if piece and b" " not in piece[1:] and not any(65 <= b <= 90 for b in piece):
                best[piece] = max(best.get(piece, -math.inf), model.get_score(i))
    return list(best), np.array(list(best.values()))


def first_weights(scores: np.ndarray) -> np.ndarray:
    """Probabilities from the file's scores.  Scores that are log probabilities (they sum to about one) are taken as such; the scores
    of a merge vocabulary are ranks, whose probabilities follow Zipf's law.  Bytes without a score get the least."""
    known = np.isfinite(scores)
    p = np.exp(np.clip(scores, -700, 0), where=known, out=np.zeros(len(scores)))
    if not 0.5 < p.sum() < 1.5:
        rank = np.empty(len(scores))
        rank[np.argsort(-scores, kind="stable")] = np.arange(1, len(scores) + 1)
        p = 1 / rank
    p[~known | (p <= 0)] = p[known & (p > 0)].min()
    return p / p.sum()


class Lattice:
    """Finds the pieces at all places of many words at once, and sums over segmentations."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        self.pieces, self.logp = pieces, logp
        self.number = {p: i for i, p in enumerate(pieces)}
        self.lengths = sorted({len(p) for p in pieces})
        self.value = np.random.default_rng(1).integers(1, 2**63, 256, np.uint64) | np.uint64(1)
        self.power = np.array([pow(_BASE, i, 2**64) for i in range(max(self.lengths) + 1)], np.uint64)
        self.codes = np.array([self._code(p) for p in pieces], np.uint64)
        slot = self._slot(self.codes)
        self.head, self.next = np.full(1 << _SLOTS, -1, np.int32), np.full(len(pieces), -1, np.int32)
        for i, s in enumerate(slot.tolist()):
            self.next[i], self.head[s] = self.head[s], i

    def _code(self, piece: bytes) -> int:
        code = 0
        for b in piece:
            code = (code * _BASE + int(self.value[b])) % 2**64
        return code

    @staticmethod
    def _slot(code: np.ndarray) -> np.ndarray:
        return ((code ^ (code >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def _arcs(self, words: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each end place: (start place, rows, pieces) of the pieces that end there, in words of equal length (a row each)."""
        n, size = words.shape
        hashes = [np.zeros(n, np.uint64)]
        for j in range(size):
            hashes.append(hashes[-1] * np.uint64(_BASE) + self.value[words[:, j]])
        arcs: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(size + 1)]
        for j in range(1, size + 1):
            for length in self.lengths:
                if length > j:
                    break
                code = hashes[j] - hashes[j - length] * self.power[length]
                found = self.head[self._slot(code)]
                rows = np.flatnonzero(found >= 0)
                found, hit, own = found[rows], [], []
                while len(rows):
                    same = self.codes[found] == code[rows]
                    hit.append(rows[same])
                    own.append(found[same])
                    on = ~same & (self.next[found] >= 0)
                    rows, found = rows[on], self.next[found[on]]
                if hit:
                    rows, found = np.concatenate(hit), np.concatenate(own)
                    if len(rows):
                        arcs[j].append((j - length, rows, found))
        return arcs

    def _forward(self, arcs: list, n: int) -> np.ndarray:
        alpha = np.full((len(arcs), n), -np.inf)
        alpha[0] = 0
        for j in range(1, len(arcs)):
            for i, rows, pieces in arcs[j]:
                alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + self.logp[pieces])
        return alpha

    def _one(self, word: bytes) -> tuple[list[float], list[list[tuple[int, int]]]]:
        """Forward values and arcs (start, piece) by end place of a single word."""
        alpha, arcs, logp = [0.0], [[]], self.logp
        for j in range(1, len(word) + 1):
            own = [(j - n, self.number[word[j - n:j]]) for n in self.lengths if n <= j and word[j - n:j] in self.number]
            terms = [alpha[i] + logp[p] for i, p in own]
            top = max(terms)
            alpha.append(top + math.log(math.fsum(math.exp(t - top) for t in terms)))
            arcs.append(own)
        return alpha, arcs

    def _groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(sizes[sizes <= LONG]).tolist():
            at = np.flatnonzero(sizes == size)
            body = np.frombuffer(b"".join([b" " + words[i] for i in at.tolist()]), np.uint8)
            yield at, body.reshape(len(at), size + 1)

    def score(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability, summed over all its segmentations."""
        out = np.empty(len(words))
        for at, body in self._groups(words):
            out[at] = self._forward(self._arcs(body), len(at))[-1]
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self._one(b" " + w)[0][-1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of the words, each taken ``counts`` times."""
        out = np.zeros(len(self.pieces))
        for at, body in self._groups(words):
            arcs, n = self._arcs(body), len(at)
            alpha = self._forward(arcs, n)
            beta = np.full_like(alpha, -np.inf)
            beta[-1] = 0
            for j in range(len(arcs) - 1, 0, -1):
                for i, rows, pieces in arcs[j]:
                    tail = beta[j, rows] + self.logp[pieces]
                    out += np.bincount(pieces, np.exp(alpha[i, rows] + tail - alpha[-1, rows]) * counts[at[rows]], len(out))
                    beta[i, rows] = np.logaddexp(beta[i, rows], tail)
        for k, w in enumerate(words):
            if len(w) > LONG:
                alpha, arcs = self._one(b" " + w)
                tails = [-math.inf] * (len(w) + 1) + [0.0]
                for j in range(len(w) + 1, 0, -1):
                    for i, p in arcs[j]:
                        tail = tails[j] + self.logp[p]
                        out[p] += math.exp(alpha[i] + tail - alpha[-1]) * counts[k]
                        hi, lo = max(tails[i], tail), min(tails[i], tail)
                        tails[i] = hi + math.log1p(math.exp(lo - hi))
        return out


# --------------------------------------------------------------------------- blocks of texts

def _table(schema: pa.Schema, n: int, /, **columns: object) -> pa.RecordBatch:
    """A batch of ``n`` rows; columns that aren't given are null."""
    return pa.RecordBatch.from_arrays([pa.nulls(n, f.type) if columns.get(f.name) is None else pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def _schema(**types: pa.DataType) -> pa.Schema:
    return pa.schema(list(types.items()))


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(a.tobytes() for a in arrays), 1)


def _blocks(texts: DataFrame, block_bytes: int) -> DataFrame:
    """From (row, held, text), rows of two sorts: (word, place, n) for each distinct word of a block with its training count, and
    (block, row, held, n_tokens, numbers) for each text; ``numbers`` holds the numbers of its words and how often they occur."""
    ddl = f"word binary, place long, n long, block long, row {dict(texts.dtypes)['row']}, held boolean, n_tokens long, numbers binary"
    schema = _arrow_schema(texts.sparkSession, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 14
        number: dict[bytes, int] = {}
        trained: list[int] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            words = list(number)
            for at in range(0, len(words), WORDS):
                part = words[at:at + WORDS]
                place = (block << NUMBER_BITS) + np.arange(at, at + len(part), dtype=np.int64)
                yield _table(schema, len(part), word=part, place=place, n=trained[at:at + WORDS])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows, held, texts = (batch.column(i).slice(at, 512).to_pylist() for i in range(3))
                done: list[tuple] = []
                for row, out, text in zip(rows, held, texts, strict=True):
                    words = Counter(text.lower().split())
                    numbers = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
                    times = np.fromiter(words.values(), np.int32, len(words))
                    trained.extend([0] * (len(number) - len(trained)))
                    if not out:
                        for i, t in zip(numbers.tolist(), words.values(), strict=True):
                            trained[i] += t
                    done.append((block, row, out, int(times.sum()) + 1, _pack(numbers, times)))
                    size += len(text)
                    if size >= block_bytes:
                        yield from close()
                        number.clear()
                        trained.clear()
                        block, size = block + 1, 0
                names = ("block", "row", "held", "n_tokens", "numbers")
                yield _table(schema, len(done), **dict(zip(names, zip(*done, strict=True), strict=True)))
        yield from close()

    return texts.mapInArrow(run, ddl)


def _vocabulary(rows: DataFrame) -> DataFrame:
    """(word, c, first, places): each word with its training count and its places in blocks, in rows of at most ``PLACES`` places
    (``first`` marks one of them).  A task holds one word's places at a time: one number for each block."""
    schema = _schema(word=pa.binary(), c=pa.int64(), first=pa.bool_(), places=pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: bytes | None = None
        held: list[np.ndarray] = []
        count = 0

        def close() -> Iterator[pa.RecordBatch]:
            places = np.concatenate(held)
            for at in range(0, len(places), PLACES):
                yield _table(schema, 1, word=[last], c=[count], first=[at == 0], places=[places[at:at + PLACES]])

        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(0)
            place, n = (batch.column(i).to_numpy() for i in (1, 2))
            new = pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False)
            starts = np.concatenate(([0], np.flatnonzero(new) + 1))
            sums, ends = np.add.reduceat(n, starts), np.concatenate((starts[1:], [len(words)]))
            names = words.take(pa.array(starts))
            at = 0
            if last is not None and names[0].as_py() == last:
                held.append(place[:ends[0]])
                count += int(sums[0])
                at = 1
            if at < len(starts):
                if last is not None:
                    yield from close()
                inner = slice(at, len(starts) - 1)
                if inner.stop > inner.start:
                    a, b = starts[at], starts[-1]
                    places = pa.ListArray.from_arrays(pa.array(np.append(starts[inner], b) - a, pa.int32()), pa.array(place[a:b]))
                    yield pa.RecordBatch.from_arrays([names.slice(at, inner.stop - at), pa.array(sums[inner]), pa.array(np.ones(inner.stop - at, bool)), places], schema=schema)
                last, held, count = names[-1].as_py(), [place[starts[-1]:]], int(sums[-1])
        if last is not None:
            yield from close()

    return (rows.where(F.col("word").isNotNull()).select("word", "place", "n").repartition("word").sortWithinPartitions("word")
            .mapInArrow(run, "word binary, c long, first boolean, places array<long>"))


# --------------------------------------------------------------------------- training and scoring

class Model:
    """Totals of the training texts and the pieces' probabilities; ``word_scores`` gives log10 probabilities."""

    def __init__(self, pieces: list[bytes], p: np.ndarray, n_tokens: int, n_texts: int, n_words: int, once: int, twice: int):
        self.pieces, self.p = pieces, p
        self.n_tokens, self.n_texts, self.n_words = n_tokens, n_texts, n_words
        #: Distinct training tokens, the end among them.
        self.distinct = n_words + (n_texts > 0)
        self.discount = min(0.9, once / (once + 2 * twice)) if once else 0.5
        self.end = math.log10(n_texts / n_tokens) if n_tokens else math.log10(0.5)
        # with ends only, words get the share of half a token
        self.pieces_weight = math.log((self.discount * n_words or 0.5) / n_tokens) if n_tokens else math.log(0.5)

    def lattice(self) -> Lattice:
        return Lattice(self.pieces, np.log(self.p))

    def word_scores(self, lattice: Lattice, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        own = np.full(len(words), -np.inf)
        known = counts > 0
        own[known] = np.log((counts[known] - self.discount) / self.n_tokens)
        return np.logaddexp(own, self.pieces_weight + lattice.score(words)) / math.log(10)

    def base(self, counts: np.ndarray | int) -> np.ndarray:
        return np.log10((counts + 1) / (self.n_tokens + self.distinct + 1))


def _expected(vocabulary: DataFrame, model: Model) -> np.ndarray:
    """Expected uses of each piece over the segmentations of all training words."""
    schema = _schema(piece=pa.int64(), uses=pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = model.lattice()
        uses = np.zeros(len(model.pieces))
        for batch in batches:
            words = batch.column(0).to_pylist()
            uses += lattice.expected(words, np.ones(len(words)))
        at = np.flatnonzero(uses)
        yield _table(schema, len(at), piece=at, uses=uses[at])

    words = vocabulary.where(F.col("first") & (F.col("c") > 0)).select("word")
    out = np.zeros(len(model.pieces))
    for r in words.mapInArrow(run, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
        out[r["piece"]] = r["uses"]
    return out


def train(vocabulary: DataFrame, n_texts: int, vocabulary_path: str, rounds: int = ROUNDS) -> Model:
    """A model of the words with training counts; ``n_texts`` is the number of training texts."""
    pieces, scores = read_pieces(vocabulary_path)
    c = F.col("c")
    got = vocabulary.where(F.col("first") & (c > 0)).agg(F.sum("c").alias("n"), F.count("*").alias("words"), F.count_if(c == 1).alias("once"),
                                                         F.count_if(c == 2).alias("twice")).first()
    model = Model(pieces, first_weights(scores), (got["n"] or 0) + n_texts, n_texts, got["words"], got["once"], got["twice"])
    for _ in range(rounds if got["words"] else 0):
        uses = _expected(vocabulary, model) + SMOOTHING
        model.p = uses / uses.sum()
    return model


def _scored(vocabulary: DataFrame, model: Model) -> DataFrame:
    """(block, packed): for the words of each block their numbers, training counts and log10 probabilities."""
    schema = _schema(block=pa.int64(), packed=pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = model.lattice()
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            places = batch.column(2)
            each = np.diff(places.offsets.to_numpy())
            score, at = np.repeat(model.word_scores(lattice, words, counts), each), places.flatten().to_numpy()
            counts = np.repeat(counts, each)
            order = np.argsort(at, kind="stable")
            at, counts, score = at[order], counts[order], score[order]
            blocks, starts = np.unique(at >> NUMBER_BITS, return_index=True)
            ends = np.append(starts[1:], len(at))
            packed = [_pack((at[a:b] & ((1 << NUMBER_BITS) - 1)).astype(np.int32), counts[a:b], score[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield _table(schema, len(packed), block=blocks, packed=packed)

    return vocabulary.select("word", "c", "places").mapInArrow(run, "block long, packed binary")


def _sums(rows: DataFrame, scored: DataFrame, model: Model) -> DataFrame:
    """(row, held, n_tokens, n_known, base_score, score) of each text: the words' scores meet the texts of their block."""
    ddl = f"row {dict(rows.dtypes)['row']}, held boolean, n_tokens long, n_known long, base_score double, score double"
    schema = _arrow_schema(rows.sparkSession, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, count, base, score = None, *[np.empty(0)] * 3
        parts: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for own, packed, row, held, n_tokens, numbers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != block:
                    block, count, parts = own, np.empty(0), []
                if packed is not None:
                    raw = zstandard.decompress(packed)
                    n = len(raw) // 20
                    parts.append((np.frombuffer(raw, np.int32, n), np.frombuffer(raw, np.int64, n, 4 * n), np.frombuffer(raw, np.float64, n, 12 * n)))
                    continue
                if parts:
                    at = np.concatenate([p[0] for p in parts])
                    count, score = np.empty(len(at), np.int64), np.empty(len(at))
                    count[at], score[at] = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
                    base, parts = model.base(count), []
                at, times = np.frombuffer(zstandard.decompress(numbers), np.int32).reshape(2, -1)
                known, plain, own_score = (0, 0.0, 0.0) if not len(at) else (int(times[count[at] > 0].sum()), float(base[at] @ times), float(score[at] @ times))
                out.append((row, held, n_tokens, known + (model.n_texts > 0), plain + float(model.base(model.n_texts)), own_score + model.end))
            yield _table(schema, len(out), **dict(zip(schema.names, zip(*out, strict=True), strict=True)) if out else {})

    texts = rows.where(F.col("n_tokens").isNotNull()).select("block", F.lit(None).cast("binary").alias("packed"), "row", "held", "n_tokens", "numbers")
    both = texts.unionByName(scored, allowMissingColumns=True)
    return (both.repartition("block").sortWithinPartitions("block", F.col("packed").isNull())
            .mapInArrow(run, ddl))


def held_out(id_col: str | Column, of: int = 7, is_: int = 2) -> Column:
    """Whether crc32(id as text) mod ``of`` is ``is_``; a null id is in training."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % of == is_, F.lit(False))


def score_texts(docs: DataFrame, vocabulary_path: str, text: str = "text", id_col: str = "doc_id", *, held: Column | None = None,
                rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each text: its id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities).

    Texts that are ``held`` out (by default by the crc32 of their id) are scored, but nothing is learned from them."""
    texts = docs.select(docs[id_col].alias("row"), (held_out(docs[id_col]) if held is None else held).alias("held"), text_bytes(docs[text]).alias("text"))
    rows = stage(_blocks(texts, block_bytes), "lm-blocks")
    vocabulary = stage(_vocabulary(rows), "lm-words")
    n_texts = rows.where(F.col("n_tokens").isNotNull() & ~F.col("held")).count()
    model = train(vocabulary, n_texts, vocabulary_path, rounds)
    out = _sums(rows, _scored(vocabulary, model), model)
    return out.select(F.col("row").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
