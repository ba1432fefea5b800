"""License scans (9): MinHash bands over overlapping text windows, exact shingle containment.

Texts and templates are folded to words (ASCII lower case, letters, digits and all non-ASCII characters) and to
five-word shingles. A template of T shingles, ``MIN_SHINGLES`` or more, belongs to the
size class S, the power of two at or above T; for each class a text is covered by windows of S + step shingles
at every ``step`` = max(1, S // 2) shingles. A contiguous copy of a template that keeps 80 % of its shingles
lies inside one window and has a Jaccard similarity of 0.25 or more with it, so with bands of one row
32 bands retrieve it with a probability of 0.9999 (``choose_bands``). Retrieved windows are verified: the
share of the template's shingles in the window must be ``containment`` or more.

A shorter template of W words is aligned word by word: a copy may differ by k = floor((1 - containment) * W) words (changed, left out
or added), and its containment is 1 - edits / W. Cut into k + 1 pieces, such a copy holds one piece exactly, so every place of a piece
is aligned and none is missed. Numbers in a short template must stand in the copy as they are.

Where licences differ by a few words only, ``keys`` names phrases that the copy must hold (``license_texts.KEYS``), so that a near copy
of one isn't taken for the other.

Defined results: null and empty texts match nothing and give no row; a template
without words never matches; repeated rows and templates each give their rows; ties between windows go to
the best, then the first; other columns are ignored.

Templates are the shipped table (whole texts, headers, notices) or the caller's, at most ``MAX_TEMPLATE_WORDS`` words in all (an error beyond: scan in several calls); they
go to every task. A task holds one text at a time; nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import license_texts
from .common import WordHashes, choose_bands, gram_hashes, mapped, mix64, ship, text_bytes

ship(__name__)

SHINGLE = 5
#: Templates with fewer shingles are aligned: a changed word would cost up to ``SHINGLE`` of them.
MIN_SHINGLES = 10
MAX_TEMPLATE_WORDS = 1_000_000
LEAST_JACCARD = 0.25
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def fold_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _class(shingles: int) -> int:
    return 1 << max(0, shingles - 1).bit_length()


def aligned(template: list[bytes], words: list[bytes]) -> tuple[int, int, int]:
    """(edits, start, end) of the run of words nearest to the template; ties go to the first end, then the shortest run."""
    row = [(0, j) for j in range(len(words) + 1)]  # least edits of the template's words so far against a run ending here, and its start
    for i, t in enumerate(template, 1):
        last, row = row, [(i, 0)]
        for j, w in enumerate(words, 1):
            row.append(min((last[j - 1][0] + (w != t), -last[j - 1][1]), (last[j][0] + 1, -last[j][1]), (row[j - 1][0] + 1, -row[j - 1][1])))
            row[j] = (row[j][0], -row[j][1])
    end = min(range(len(row)), key=lambda j: (row[j][0], j))
    return row[end][0], row[end][1], end


def parse_keys(keys: str) -> list[list[bytes]]:
    return [[b" " + b" ".join(fold_words(k.encode())) + b" " for k in any_of.split("|")] for any_of in keys.split(";") if any_of.strip()]


def holds(keys: list[list[bytes]], words: list[bytes]) -> bool:
    body = b" " + b" ".join(words) + b" "
    return all(any(k in body for k in any_of) for any_of in keys)


class Templates:
    """Shingle sets of the long templates, and for each size class the band values that retrieve them; words and pieces of the short ones."""

    def __init__(self, texts: list[tuple[str, bytes]], recall: float, containment: float, keys: dict[str, str], seed: int = 3):
        self.bands, rows = choose_bands(LEAST_JACCARD, recall, 64)
        assert rows == 1
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 2**63, self.bands, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, self.bands, np.uint64)
        self.containment = containment
        known = WordHashes()
        self.names: list[str] = []
        self.keys: list[list[list[bytes]]] = []
        self.sets: dict[int, np.ndarray] = {}  # shingles of the long templates
        self.short: dict[int, tuple[list[bytes], int]] = {}  # words of the short templates, and the edits allowed
        #: The shingles that give the templates' band values. The hash functions are bijective, so a window without
        #: any of them shares no band with a template.
        self.least = np.empty(0, np.uint64)
        self.table: dict[int, list[dict[int, list[int]]]] = {}
        pieces: dict[int, dict[int, list[tuple[int, int]]]] = {}  # by length: hash to (template, place in it)
        for name, text in texts:
            words = fold_words(text)
            if not words:
                continue
            k = len(self.names)
            self.names.append(name)
            self.keys.append(parse_keys(keys.get(name, "")))
            grams = np.unique(gram_hashes(known.of(words), SHINGLE))
            if len(grams) < MIN_SHINGLES:
                edits = min(len(words) - 1, int((1 - containment) * len(words) + 1e-9))
                self.short[k] = words, edits
                self.keys[k] += [[b" " + w + b" "] for w in words if any(48 <= c <= 57 for c in w)]
                cut = [len(words) * i // (edits + 1) for i in range(edits + 2)]
                for a, b in zip(cut, cut[1:], strict=False):
                    h = int(gram_hashes(known.of(words[a:b]), b - a)[0])
                    pieces.setdefault(b - a, {}).setdefault(h, []).append((k, a))
                continue
            self.sets[k] = grams
            bands = self.table.setdefault(_class(len(grams)), [{} for _ in range(self.bands)])
            for band, value in zip(bands, self.values(grams).min(axis=1).tolist(), strict=True):
                band.setdefault(value, []).append(k)
            self.least = np.unique(np.append(self.least, grams[np.unique(self.values(grams).argmin(axis=1))]))
        self.pieces = {n: (np.array(sorted(of), np.uint64), of) for n, of in pieces.items()}

    def values(self, grams: np.ndarray) -> np.ndarray:
        return mix64(grams[None, :] * self.a[:, None] + self.b[:, None])

    def candidates(self, grams: np.ndarray) -> set[tuple[int, int, int]]:
        """(template, first shingle, end) of the windows that share a band with a template."""
        found: set[tuple[int, int, int]] = set()
        for k in range(self.bands):
            v = mix64(grams * self.a[k] + self.b[k])
            for size, bands in self.table.items():
                step = max(1, size // 2)
                width = size + step
                starts = np.arange(0, max(1, len(v) - width + step), step)
                least = np.minimum.reduceat(v, starts)  # least of each step
                low = least.copy()
                for i in range(1, -(-width // step)):
                    low[:-i] = np.minimum(low[:-i], least[i:])
                wanted = np.fromiter(bands[k], np.uint64, len(bands[k]))
                for w in np.flatnonzero(np.isin(low, wanted)).tolist():
                    found.update((t, w * step, min(len(v), w * step + width)) for t in bands[k][int(low[w])])
        return found

    def matches(self, words: list[bytes], known: WordHashes) -> list[tuple[str, float, int]]:
        """(template, containment, first word of the best place) of the templates that the text contains."""
        best: dict[int, tuple[float, int]] = {}
        h = known.of(words)
        grams = gram_hashes(h, SHINGLE)
        if len(grams) and len(self.least) and among(grams, self.least).any():
            for t, a, b in sorted(self.candidates(grams)):
                inside = np.isin(self.sets[t], grams[a:b])
                share = float(inside.sum()) / len(inside)
                if share >= self.containment and share > best.get(t, (0.0, 0))[0] and holds(self.keys[t], words[a:b + SHINGLE - 1]):
                    best[t] = (share, a + int(np.flatnonzero(np.isin(grams[a:b], self.sets[t]))[0]))
        places: set[tuple[int, int]] = set()
        for n, (wanted, of) in self.pieces.items():
            grams = gram_hashes(h, n)
            for at in np.flatnonzero(among(grams, wanted)).tolist() if len(grams) else ():
                places.update((t, at - place) for t, place in of[int(grams[at])])
        for t, at in sorted(places):
            template, edits = self.short[t]
            a = max(0, at - edits)
            n, start, end = aligned(template, words[a:max(0, at + len(template) + edits)])
            share = 1 - n / len(template)
            if n <= edits and share > best.get(t, (0.0, 0))[0] and holds(self.keys[t], words[a + start:a + end]):
                best[t] = (share, a + start)
        return [(self.names[t], *best[t]) for t in sorted(best)]


def among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which values are in ``wanted`` (sorted, not empty)."""
    return wanted[np.searchsorted(wanted[:-1], values)] == values


def scan(docs: DataFrame, templates: dict[str, str] | DataFrame | None = None, text: str = "text", doc_id: str = "doc_id", *,
         recall: float = 0.9999, containment: float = 0.8, keys: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, license, containment, first_word): a row for each template that a document contains.

    ``templates``: texts by name, or a DataFrame (name, text); the shipped table by default. ``keys``: phrases by template name.
    """
    if templates is None:
        templates, keys = license_texts.shipped(), license_texts.KEYS | (keys or {})
    if isinstance(templates, DataFrame):
        size = templates.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
        if size > MAX_TEMPLATE_WORDS:
            raise ValueError(f"{size} words of templates; at most {MAX_TEMPLATE_WORDS} go in one scan")
        pairs = [(r["name"], (r["text"] or "").encode()) for r in templates.orderBy("name").collect()]
    else:
        pairs = [(k, v.encode()) for k, v in templates.items()]
    of = Templates(pairs, recall, containment, keys or {})

    def look(cols: dict[str, list]) -> dict[str, list]:
        known = WordHashes()
        out: dict[str, list] = {"doc_id": [], "license": [], "containment": [], "first_word": []}
        for i, t in zip(cols["doc_id"], cols["text"], strict=True):
            for name, share, at in of.matches(fold_words(t), known):
                out["doc_id"].append(i)
                out["license"].append(name)
                out["containment"].append(share)
                out["first_word"].append(at)
        return out

    kind = dict(docs.dtypes)[doc_id]
    return mapped(docs.select(docs[doc_id].alias("doc_id"), text_bytes(docs[text]).alias("text")), look,
                  f"doc_id {kind}, license string, containment double, first_word long", rows=2048)
