"""Small tables with the cases every operator must handle, and brute-force counterparts."""

import collections
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns besides those of documents, named like the operators' scratch columns.
CLASH = ["rid", "c0", "node", "block", "kept", "n_words", "first", "shard", "entities"]
DDL = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)


def words(text):
    return WORD.findall(text or "")


def odd_rows(seed=5):
    """Nulls in any column, empty, blank and very long texts, copies, near copies, repeated rows, a hot source, shared lines and spans."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["Él", "naïve", "straße", "x,", "y."]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    span, line = say(70), "all rights reserved by the authors of this page today"
    base = say(120)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", "   \n\t ", "one", "a b c d", base, base, " ".join(near), base + "\n" + line, say(3000), say(40) + "\n" + span, span + "\n" + say(30),
             "a b c d e f g h " * 8, "\n".join([line] * 3 + [say(30)]), say(25) + "###|||", say(60) + "\n\n" + say(10)]
    texts += [say(rng.randrange(20, 90)) + "\n" + line for _ in range(30)] + [say(rng.randrange(20, 120)) for _ in range(40)]
    rows = [(i, t, rng.choice(["en", "de", None]), "hot" if i % 3 else rng.choice(["a", "b", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, "a text without an id " * 3, None, None, None)] + [rows[9]] * 3 + [rows[5]] * 6
    return [r + ("x",) * len(CLASH) for r in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, DDL).repartition(5)


def empty(spark):
    return spark.createDataFrame([], DDL)


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i:i + min(n, len(w))]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def links(rows):
    """Linked pairs (row numbers) and the component of each row, by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    where = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    both = collections.Counter((a, b) for at in where.values() for k, b in enumerate(at) for a in at[:k])
    pairs = [p for p, n in both.items() if 5 * n >= 4 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return pairs, label


def removed(rows, window=50):
    """Covered word places of each row by the span rule, null ids smallest."""
    key = lambda r: -2**63 if r[0] is None else r[0]
    first = {}
    for r in sorted(rows, key=key):
        w = words(r[1])
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), key(r))
    out = []
    for r in rows:
        w, gone = words(r[1]), set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < key(r):
                gone.update(range(i, i + window))
        out.append(gone)
    return out
