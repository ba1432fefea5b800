"""Periodic runs, conversation trie and lattice language model against brute force."""

import collections
import hashlib
import math
import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases as K

from tidemark.llm import conversation_trie, lattice_lm, oracles, periodic_runs, queries

SF = "/root/testdata/sf0.001"


# --- op11

def brute_runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    out = []
    while len(out) < rng.randrange(1, 420):
        if rng.random() < 0.5:
            unit = [rng.randrange(rng.choice([1, 2, 3, 30, 300])) for _ in range(rng.randrange(1, 90))]
            whole = unit * rng.randrange(1, 6)
            out += whole[:rng.randrange(len(whole)) + 1]
        else:
            out += [rng.randrange(rng.choice([2, 5, 1000])) for _ in range(rng.randrange(1, 40))]
    return out


def test_runs_of_random_words():
    rng = random.Random(4)
    n = 0
    for _ in range(250):
        w = random_words(rng)
        want = brute_runs(w)
        assert periodic_runs.runs_of(w) == want
        gone = {i for s, length, q in want for i in range(s + q, s + length)}
        assert periodic_runs.collapse(w, want) == [x for i, x in enumerate(w) if i not in gone]
        n += sum(q > periodic_runs.DENSE for _, _, q in want)
    assert n > 20  # long periods go the sampled way


def test_splitting_keeps_whole_runs_only():
    assert periodic_runs.segments(np.arange(50)) == []
    x = np.array([0, 1] * 10 + [9] + [2, 3, 4] * 3 + [8] + [5, 6] * 6)
    assert periodic_runs.segments(x) == [(0, 20), (31, 43)]
    assert periodic_runs.runs_of(["a"] * 50_000) == [(0, 50_000, 1)]


def run_row(doc_id, text, rebuilt):
    w = K.words(text)
    n, h = len(w), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if rebuilt and h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4), sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_runs_of_odd_rows(spark):
    rows = K.odd_rows()
    got = periodic_runs.run_digest(periodic_runs.find_runs(periodic_runs.repeated_tails(K.frame(spark, rows))))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((run_row(r[0], r[1], True) for r in rows), key=str)
    plain = periodic_runs.find_runs(K.frame(spark, rows)).collect()
    assert sorted(r["n_words"] for r in plain) == sorted(len(K.words(r[1])) for r in rows)
    assert periodic_runs.run_digest(periodic_runs.find_runs(periodic_runs.repeated_tails(K.empty(spark)))).count() == 0


def test_op11_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where(F.length("text") < 6000).collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert all(got[r["doc_id"]] == run_row(r["doc_id"], r["text"], True) for r in docs) and any(r[1] for r in got.values())


# --- op12

def in_order(rows):
    by = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            by[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r)} {r} {x}".encode()).hexdigest()[:32], (r, x)))
    return {c: [x[-1] for x in sorted(v)] for c, v in by.items()}


def shared(by):
    out = {}
    for c, v in by.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = by.get(c - c % 100, [])[:h] + v[h:]
    return out


def brute_trie(convs):
    members, children = collections.defaultdict(list), collections.defaultdict(list)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in children[p])
        ends = ",".join(str(c) for c in sorted(members[p]) if len(convs[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = "conv_id long, turn int, role string, text string, label string, k string, conv string, digest string"


def odd_turns(seed):
    """Null ids, turns, roles and texts, repeated rows, equal turn numbers, few different texts, a conversation with half of all turns."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(60), 100, 103, 250, 7777]) if i < 300 else 7, rng.choice([None, *range(200)]) if i % 3 else None,
             rng.choice(["u", None, ""]), rng.choice(["a", "é", None, "bb", "日本"])) for i in range(600)]
    rows += rows[:5] * 2
    return rows + [(c, t, "u", "same") for c in range(300, 330) for t in range(9)]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_odd_turns(spark, monkeypatch, seed):
    monkeypatch.setattr(conversation_trie, "SPAN", 4)
    monkeypatch.setattr(conversation_trie, "CHUNK", 20)
    rows = odd_turns(seed)
    df = spark.createDataFrame([r + ("x",) * 4 for r in rows], TURNS).repartition(5)
    own = conversation_trie.conversation_trie(df)
    assert own.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, own.collect()), key=str) == brute_trie(in_order(rows))
    made = conversation_trie.prefix_trie(*conversation_trie.shared_heads(conversation_trie.ordered_turns(df)))
    assert sorted(map(tuple, made.collect()), key=str) == brute_trie(shared(in_order(rows)))


def test_trie_without_turns_or_rows(spark):
    nothing = spark.createDataFrame([], TURNS)
    assert conversation_trie.conversation_trie(nothing).count() == 0
    turns = conversation_trie.ordered_turns(nothing)
    got = conversation_trie.prefix_trie(spark.createDataFrame([(3,), (2,), (3,)], "conv long"), turns).collect()
    assert list(map(tuple, got)) == brute_trie({2: [], 3: []})


def test_trie_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.sql(oracles.CONVERSATION_TRIE).fetchall()
    assert sorted(want, key=str) == sorted(map(tuple, queries.op12_conversation_trie(spark, SF).collect()), key=str)


# --- op13

def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def small_lattice():
    pieces = [bytes([b]) for b in range(256)] + [b" t", b" th", b"he", b" the", b"th", b"ex", b"\xc3\xa9", b"e\xc3\xa9", b"aaa", b"aa"]
    p = np.random.default_rng(3).random(len(pieces))
    return pieces, p / p.sum()


def segmentations(word, pieces):
    if not word:
        return [[]]
    return [[p, *rest] for p in pieces if word.startswith(p) for rest in segmentations(word[len(p):], pieces)]


def test_lattice_sums_over_all_segmentations(small_lattice):
    pieces, p = small_lattice
    of = dict(zip(pieces, p, strict=True))
    lattice = lattice_lm.Lattice(pieces, np.log(p))
    words = [b"the", b"thehe", b"hexe", "eéé".encode(), b"t", b"aaaaaaa", b"x" * 3, b"the", b"\x00\xff"]
    ways = [segmentations(b" " + w, pieces) for w in words]
    weight = [[math.prod(of[x] for x in s) for s in way] for way in ways]
    assert np.allclose(lattice.score(words), [math.log(sum(x)) for x in weight])
    want = np.zeros(len(pieces))
    for way, own, times in zip(ways, weight, range(1, 10), strict=True):
        for s, x in zip(way, own, strict=True):
            for piece in s:
                want[pieces.index(piece)] += times * x / sum(own)
    assert np.allclose(lattice.expected(words, np.arange(1.0, 10)), want)
    long = [b"the" * 40, b"aa" * 300]  # one at a time, as a group
    alone = lattice.score(long), lattice.expected(long, np.ones(2))
    lattice_lm.LONG, limit = 10_000, lattice_lm.LONG
    try:
        assert np.allclose(alone[0], lattice.score(long)) and np.allclose(alone[1], lattice.expected(long, np.ones(2)))
    finally:
        lattice_lm.LONG = limit


def test_expectation_maximisation_never_lowers_the_likelihood(small_lattice):
    pieces, p = small_lattice
    words = [b"the", b"then", b"hex", b"aaaa", b"thaaex"]
    likelihood = []
    for _ in range(5):
        lattice = lattice_lm.Lattice(pieces, np.log(p))
        likelihood.append(lattice.score(words).sum())
        uses = lattice.expected(words, np.ones(5)) + 1e-12
        p = uses / uses.sum()
    assert all(b >= a - 1e-9 for a, b in zip(likelihood, likelihood[1:], strict=False)) and likelihood[-1] > likelihood[0] + 1


def test_probabilities_sum_to_one():
    pieces = [bytes([b]) for b in b" ab"] + [b" a", b"ab"]
    p = np.array([0.3, 0.1, 0.1, 0.3, 0.2])
    lattice = lattice_lm.Lattice([bytes([b]) for b in range(256)] + [b" a", b"ab"], np.log(np.r_[[dict(zip(pieces, p, strict=True)).get(bytes([b]), 1e-300) for b in range(256)], 0.3, 0.2]))
    strings, total = [b""], 0.0
    for _ in range(12):  # all words of a and b up to 12 letters; the rest is what longer words have
        total += np.exp(lattice.score(strings)).sum()
        strings = [w + x for w in strings for x in (b"a", b"b")]
    assert 0.95 < total < 1
    model = lattice_lm.Model([], np.empty(0), n_tokens=100, n_texts=10, n_words=30, once=20, twice=5)
    known = 90 / 100 - model.discount * 30 / 100  # 90 training tokens of 30 words
    assert math.isclose(known + math.exp(model.pieces_weight) + 10**model.end, 1)


def test_scores_of_odd_rows(spark):
    rows = K.odd_rows()
    out = lattice_lm.score_texts(K.frame(spark, rows), vocabulary(), block_bytes=2000)  # several blocks
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = out.collect()
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    low = lambda t: (t or "").encode().lower().split()
    count = collections.Counter(w for r in rows if not held(r[0]) for w in [*low(r[1]), None])
    n, v = sum(count.values()), len(count)
    pieces, scores = lattice_lm.read_pieces(vocabulary())
    of = collections.Counter(c for w, c in count.items() if w is not None)
    model = lattice_lm.Model(pieces, lattice_lm.first_weights(scores), n, count[None], v - 1, of[1], of[2])
    train = [w for w in count if w is not None]
    for _ in range(lattice_lm.ROUNDS):
        uses = lattice_lm.Lattice(pieces, np.log(model.p)).expected(train, np.ones(len(train))) + lattice_lm.SMOOTHING
        model.p = uses / uses.sum()
    lattice, want = model.lattice(), []
    for r in rows:
        w = low(r[1])
        every = [*w, None]
        own = model.word_scores(lattice, w, np.array([count[x] for x in w])) if w else np.zeros(0)
        want.append((str(r[0]), held(r[0]), len(every), sum(count[x] > 0 for x in every), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in every), 6),
                     round(float(own.sum()) + math.log10(count[None] / n), 6)))
    have = [(str(r["doc_id"]), *r[1:5], round(r["base_score"], 6), round(r["score"], 6)) for r in got]
    assert collections.Counter(x[:5] for x in have) == collections.Counter(x[:5] for x in want)
    for a, b in zip(sorted(have), sorted(want), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-4 and abs(a[6] - b[6]) < 1e-4


def test_scores_without_training_or_rows(spark):
    assert lattice_lm.score_texts(K.empty(spark), vocabulary()).count() == 0
    only = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lattice_lm.score_texts(only, vocabulary(), held=F.lit(True)).collect()}
    assert got[2]["score"] == math.log10(0.5) and got[1]["score"] < got[2]["score"] and got[1]["train_tokens"] == got[1]["n_known"] == 0


def test_held_out_texts_teach_nothing_and_training_helps(spark):
    rng = random.Random(2)
    say = lambda: " ".join("".join(rng.choice(["th", "er", "on", "ing", "re"]) for _ in range(rng.randrange(1, 5))) for _ in range(60))
    rows = [(i, say()) for i in range(80)]
    first = lattice_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary(), held=F.col("doc_id") >= 60).collect()
    other = rows[:60] + [(i, say()) for i in range(60, 79)] + [rows[79]]  # other held-out texts leave the model as it is
    second = lattice_lm.score_texts(spark.createDataFrame(other, "doc_id long, text string"), vocabulary(), held=F.col("doc_id") >= 60).collect()
    score = lambda got, k: next(r["score"] for r in got if r["doc_id"] == k)
    assert all(math.isclose(score(first, k), score(second, k), rel_tol=1e-9) for k in (0, 30, 79))
    untrained = lattice_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary(), held=F.col("doc_id") >= 60, rounds=0).collect()
    total = lambda got: sum(r["score"] for r in got if r["held_out"])
    assert total(first) > total(untrained)
