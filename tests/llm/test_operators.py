import collections
import hashlib
import os
import re
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases as K

from tidemark.llm import decontam, jaccard_join, kd_sharding, license_scan, license_texts, line_chunks, line_quality, mixing, pii_surrogates, span_dedup, token_store
from tidemark.llm.common import STAGED, choose_bands, grouped, release

BENCH = "item_id long, text string, rid string"


@pytest.fixture(scope="module")
def rows():
    return K.odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return K.frame(spark, rows).cache()


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- op1

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=400))
def test_elias_fano_round_trip(gaps):
    ends = np.cumsum(gaps)
    code = token_store.Boundaries(len(ends), *token_store.elias_fano(ends))
    assert code.all().tolist() == ends.tolist() == [code.select(i) for i in range(len(ends))]


def test_chunks_encode_like_whole_texts():
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(tokenizer()), token_store.ChunkEncoder(tokenizer(), "<u2", limit=50)
    texts = ["a.b, C.D., <|endoftext|>, <|ENDOFTEXT|>. x<|endoftext|>.", "Él. ÉL, Ça,, 3.5, it's, IT'S. don’t.", "ﬁ, é. ́, İ. ß, ẞ. Σας, ΟΔΟΣ. 12,3. ...",
             " x y,　z .", "日本語, が゙.", "\x00a. \x1f, \x1c ‍.", "", " \n", *[r[1] for r in K.odd_rows() if r[1]]]
    for _ in range(2):
        for text, got in zip(texts, own.encode([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(got, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_token_store(spark, docs, rows):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer())
    ids = [(r[0], whole.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows]
    store = token_store.write_store(docs, tokenizer(), segment_ids=500)
    got = token_store.read_documents(store).orderBy("start").collect()
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k)) and store.count() > 5
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    want = collections.Counter((k, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in ids)
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert token_store.read_documents(token_store.write_store(K.empty(spark), tokenizer())).count() == 0
    for key in (0, 9, 20, 85):
        assert sorted(r["ids"] for r in token_store.read_document(store, key).collect()) == sorted(x for k, x in ids if k == key)
    assert token_store.read_document(store, 10**6).count() == 0


def test_encoder_memory_is_bounded_and_cased_tokenizers_are_refused():
    import public_tokenizers
    from tokenizers import Tokenizer

    own, whole = token_store.ChunkEncoder(tokenizer(), "<u2", limit_bytes=2000), Tokenizer.from_file(tokenizer())
    for k in range(40):
        text = f"{'x' * 900}{k} word{k} Übung ǆ ß"
        assert np.frombuffer(own.encode([text.encode()])[0], "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids
        assert own.held < 4000
    with pytest.raises(ValueError, match="runs"):
        token_store.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), "<u2")


def test_remembered_words_take_little_and_stay_for_the_next_task():
    import tracemalloc

    import pyarrow as pa
    from tokenizers import Tokenizer

    own, n = token_store._kept_encoder(tokenizer(), "<u2"), 60_000
    text = " ".join(f"{np.base_repr(i * 7919 + 10**7, 36).translate({48 + d: chr(97 + d) for d in range(10)})}{'.,-'[i % 3]}" for i in range(n)).encode()
    tracemalloc.start()
    try:
        before, arrow = tracemalloc.get_traced_memory()[0], pa.total_allocated_bytes()
        got = own.encode([text])
        held, arrow = tracemalloc.get_traced_memory()[0] - before, pa.total_allocated_bytes() - arrow
    finally:
        tracemalloc.stop()
    assert held + arrow < 120 * n
    assert np.frombuffer(got[0], "<u2").tolist() == Tokenizer.from_file(tokenizer()).encode(text.decode(), add_special_tokens=False).ids
    assert token_store._kept_encoder(tokenizer(), "<u2") is own and own.encode([text]) == got
    assert token_store._kept_encoder(tokenizer(), "<u4") is not own and token_store._kept_encoder(tokenizer(), "<u2") is not own


def test_every_text_of_a_table_is_encoded_like_the_whole(spark):
    from tokenizers import Tokenizer

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    own, whole = token_store.ChunkEncoder(tokenizer(), "<u2"), Tokenizer.from_file(tokenizer())
    for r, got in zip(rows, own.encode([r["text"].encode() for r in rows]), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == whole.encode(r["text"], add_special_tokens=False).ids


# --- op2

def test_surrogates_keep_type_format_and_coreference(spark):
    key = b"k"
    texts = ["Mrs. Ana GARCÍA wrote to bob.7@mail.example.org from 10.2.3.4, card 4041 8949 7460 8795.", "BOB.7@MAIL.EXAMPLE.ORG or +1 (503) 555-8963, 503-555-8963",
             "Frau Müller, Господин Иван Петров, Κυρία Μαρία", None, "", "nothing here 1.2.3.400", "x" * 200_000, "Mrs. Ana GARCÍA wrote to bob.7@mail.example.org from 10.2.3.4, card 4041 8949 7460 8795."]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, entities string")
    out = {r["doc_id"]: r for r in pii_surrogates.pseudonymise(df.drop("entities"), key).collect()}
    again = {r["doc_id"]: r["text"] for r in pii_surrogates.pseudonymise(df.drop("entities"), key).collect()}
    assert {i: r["text"] for i, r in out.items()} == again and out[0]["text"] == out[7]["text"]
    kinds = [e["kind"] for e in out[0]["entities"]]
    assert kinds == ["person", "email", "ip", "card"]
    name, mail, ip, card = [e["surrogate"] for e in out[0]["entities"]]
    assert name.split()[0] in pii_surrogates.GIVEN["latin", "f"] and name.split()[1].isupper()
    assert re.fullmatch(r"[a-z]{3}\.\d@host\d+\.example\.org", mail) and out[1]["entities"][0]["surrogate"] == mail.upper()
    assert pii_surrogates.luhn_ok(card.replace(" ", "")) and [len(x) for x in card.split()] == [4] * 4 and card[0] == "4"
    assert all(int(x) < 256 for x in ip.split(".")) and ip != "10.2.3.4"
    assert out[1]["entities"][1]["surrogate"].startswith("+1 (") and out[1]["entities"][1]["surrogate"][-8:] == out[1]["entities"][2]["surrogate"][-8:]
    scripts = [pii_surrogates._script(e["surrogate"]) for e in out[2]["entities"]]
    assert scripts == ["latin", "cyrillic", "greek"]
    assert [out[i]["text"] for i in (3, 4, 5, 6)] == texts[3:7] and not any(out[i]["n_entities"] for i in (3, 4, 5, 6))
    assert pii_surrogates.pseudonymise(K.empty(spark), key).count() == 0


def test_surrogates_replace_columns_of_their_names(spark, tmp_path):
    out = pii_surrogates.pseudonymise(K.frame(spark), b"k")
    assert out.columns.count("entities") == 1 and set(out.columns) == {*K.frame(spark).columns, "n_entities"}
    out.write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(K.odd_rows())


def test_entropy_and_repetition_are_both_met_or_refused(spark):
    sources = spark.createDataFrame([(1, 1000, 3), (2, 10, 2), (3, 200, 2)], "skey long, tokens long, docs long")
    alone = mixing.exponent(sources, entropy_share=0.6)
    assert mixing.exponent(sources, entropy_share=0.6, repetition=100.0) == alone
    with pytest.raises(ValueError, match="over repetition"):
        mixing.exponent(sources, entropy_share=0.999, repetition=2.0)
    with pytest.raises(ValueError, match="over repetition"):
        mixing.exponent(sources, entropy_share=0.6, repetition=1.5, budget=10_000)


def test_surrogates_of_different_entities_differ(spark, monkeypatch):
    names = [f"Mr. Adam {a}{b}" for a in ("Bo", "Ce", "Du", "Fa") for b in ("ren", "lin", "mar", "tos", "wick")]
    df = spark.createDataFrame([(i, f"{n} met {names[i - 1]}") for i, n in enumerate(names)], "doc_id long, text string")
    monkeypatch.setattr(pii_surrogates, "SYLLABLES", {k: ["ba", "ra"] * 8 for k in pii_surrogates.SYLLABLES})  # few family names: attempts collide
    out = pii_surrogates.pseudonymise(df, b"k").collect()
    made = collections.defaultdict(set)
    for r in out:
        for e, name in zip(r["entities"], (names[r["doc_id"]], names[r["doc_id"] - 1]), strict=True):
            made[name].add(e["surrogate"])
    assert all(len(v) == 1 for v in made.values()) and len({next(iter(v)) for v in made.values()}) == len(names)


def test_names_keep_their_surrogate_without_title(spark):
    texts = ["Dr Jane Doe met Mr John Smith. Jane Doe's plan: Smith pays, said JOHN SMITH; a smith forges.", "Mrs Jane Doe, later Ms Doe's", "Doe of nobody", "Mr O’Neil-Roe spoke, O’Neil-Roe left",
             "السيد محمد علي، ثم محمد علي", "王小明先生来了，王小明走了", "श्री मोहन शर्मा, शर्मा"]
    out = [r for r in pii_surrogates.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), b"k").orderBy("doc_id").collect()]
    names = [[e["surrogate"] for e in r["entities"]] for r in out]
    jane, john, jane2, smith, shout = names[0]
    assert jane == jane2 == names[1][0] and jane.split()[0] in pii_surrogates.GIVEN["latin", "f"] and names[1][1] == jane.split()[1]
    assert smith == john.split()[1] and shout == john.upper() and out[0]["text"].endswith("a smith forges.") and f"{jane}'s plan" in out[0]["text"]
    assert names[2] == [] and out[2]["text"] == texts[2]
    assert [len(set(x)) for x in names[3:6]] == [1, 1, 1] and all(len(x) == 2 for x in names[3:]) and names[6][1] == names[6][0].split()[1]
    assert [pii_surrogates._script(x[0]) for x in names[4:]] == ["arabic", "han", "devanagari"]
    assert not any(w in r["text"] for r, w in zip(out[3:], ("Neil", "محمد", "王小明", "शर्मा"), strict=True))


def test_more_names_than_the_first_attempt_has(spark, monkeypatch):
    monkeypatch.setattr(pii_surrogates, "SYLLABLES", {k: ["ba"] * 15 + ["ra"] for k in pii_surrogates.SYLLABLES})  # 16 family names at the first attempt
    names = [f"Mr {chr(65 + i // 26)}{chr(97 + i % 26)}zz" for i in range(120)]
    out = pii_surrogates.pseudonymise(spark.createDataFrame([(i, n) for i, n in enumerate(names)], "doc_id long, text string"), b"k").collect()
    assert len({r["text"] for r in out}) == 120


def test_permutation_is_one_to_one():
    assert sorted(pii_surrogates.permute(b"k", "t", i, 1000) for i in range(1000)) == list(range(1000))


@pytest.mark.parametrize(("text", "kind", "raw"), [
    ("4111 1111 1111 1111 123", "card", "4111 1111 1111 1111"), ("4111 1111 1111 1111 12/25", "card", "4111 1111 1111 1111"),
    ("4111-1111-1111-1111 123", "card", "4111-1111-1111-1111"), ("4111111111111111 999", "card", "4111111111111111"),
    ("12345 4111 1111 1111 1111", "card", "4111 1111 1111 1111"), ("378282246310005 1234", "card", "378282246310005"),
    *[(x, "phone", x) for x in ("+14155552671", "(415)555-2671", "1-800-555-1234", "+33 1 23 45 67 89", "+49 30 12345678", "+9 (999) 999-9999",
                                "+1 (503) 555-8963", "503-555-8963", "01 23 45 67 89", "+44 20 7946 0958", "+44 (0)20 7946 0958", "+1.415.555.2671")],
    ("2001:db8::ff00:42:8329", "ip6", "2001:db8::ff00:42:8329"), ("DE89 3704 0044 0532 0130 00", "iban", "DE89 3704 0044 0532 0130 00"),
    ("GB29NWBK60161331926819", "iban", "GB29NWBK60161331926819"), ("123-45-6789", "ssn", "123-45-6789")])
def test_shapes_of_numbers(text, kind, raw):
    whole = f"reach {text}, please"
    (a, b, k, norm), *rest = pii_surrogates.find(whole)
    assert (k, whole[a:b], rest) == (kind, raw, [])
    made = pii_surrogates.rendered(raw, kind, pii_surrogates.surrogate(b"k", kind, norm, 0))
    assert made != raw and (kind == "ip6" or re.sub("[0-9]", "0", made) == re.sub("[0-9]", "0", raw))
    assert kind == "phone" or pii_surrogates.find(whole[:a] + made + whole[b:])[0][2] == kind


def test_numbers_that_are_nobodys():
    assert pii_surrogates.find("at 12:30:45 std::vector a::b 1.2.3, 2024-12-04, 1234567 and 10 20 30 40 50") == []
    norm = lambda t: pii_surrogates.find(t)[0][3]
    assert norm("+14155552671") == norm("1-415-555-2671") == norm("+1 (415) 555-2671") and norm("+33123456789") == norm("+33 1 23 45 67 89")


# --- op3

def test_kd_shards(spark, docs, rows):
    got = kd_sharding.kd_shards(docs, n_shards=6).collect()
    size = lambda r: len((r[1] or "").encode()) + 8
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == collections.Counter((r[0], size(r), zlib.crc32((r[1] or "").encode())) for r in rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    largest = max(r["size"] for r in got)
    mean = sum(r["size"] for r in got) / 6
    assert set(by) == set(range(6))
    assert all(abs(sum(r["size"] for r in x) - mean) <= 1.5 * largest and sorted(r["slot"] for r in x) == list(range(len(x))) for x in by.values())
    assert kd_sharding.kd_shards(K.empty(spark)).count() == 0


def test_kd_splits_ties_and_repeated_rows(spark):
    same = [(1, "same text", "en", "hot", 9) + ("x",) * len(K.CLASH)] * 600
    got = kd_sharding.kd_shards(K.frame(spark, same), n_shards=8).groupBy("shard").count().collect()
    assert len(got) == 8 and all(70 <= r["count"] <= 80 for r in got)


def test_kd_follows_the_widest_dimension(spark):
    n = 512
    data = [(i, "t", "en", "s", i % 2) for i in range(n)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["shard"] for r in kd_sharding.kd_shards(df, dims=("n_chars", "doc_id"), n_shards=4).collect()}
    want = {i: 2 * (i % 2) + (i >= n // 2) for i in range(n)}  # first by n_chars (listed first, equally wide), then by doc_id
    assert got == want


# --- op4

@pytest.mark.parametrize("sizes", [{}, {"min_lines": 3, "mean_lines": 2, "max_lines": 5}])
def test_line_chunks(spark, sizes):
    passage = "\n".join(f"shared line {i} of the passage" for i in range(12))
    texts = [None, "", "\n\n\n\n", "only one", passage, "intro\n" + passage + "\nend", "x\ny\nz\n" + passage, passage, "p\nq\nr\ns\nt", "\n".join(f"l{i}" for i in range(5000))]
    data = [(i, t) for i, t in enumerate(texts)] + [(None, passage), (9, texts[9])]
    df = spark.createDataFrame([(*r, "x") for r in data], "doc_id long, text string, rid string").repartition(3)
    texts_out, got = line_chunks.dedup_lines(df, **sizes), line_chunks.line_digest(df, **sizes).collect()
    lim = {"min_lines": 2, "mean_lines": 3, "max_lines": 16, "roll": 2} | sizes
    first, seen, want, kept = {}, {}, collections.Counter(), collections.Counter()
    for i, t in sorted(data, key=lambda r: -1 if r[0] is None else r[0]):
        if (i, t) not in seen:
            lines, keep, start, gone = (t or "").split("\n"), [], 0, []
            for end in line_chunks.chunk_ends([line_chunks.hash64(x.encode()) for x in lines], **lim):
                body = "\n".join(lines[start:end])
                if end - start >= lim["min_lines"] and body.strip() and body in first:
                    gone.append(end - start)
                else:
                    keep += lines[start:end]
                    first[body] = i
                start = end
            seen[i, t] = ("\n".join(keep) if gone else t, 0 if t is None else len(lines), len(gone), sum(gone))
        body, n, chunks, lines = seen[i, t]
        want[i, n, chunks, lines, None if body is None else hashlib.sha256(body.encode()).hexdigest()] += 1
        kept[i, body, "x"] += 1
    assert collections.Counter(tuple(r) for r in got) == want and collections.Counter(tuple(r) for r in texts_out.collect()) == kept
    assert sum(r["removed_lines"] for r in got) >= 20
    assert line_chunks.dedup_lines(K.empty(spark)).count() == 0 and line_chunks.line_digest(K.empty(spark)).count() == 0


# --- op5

def test_bands_reach_the_recall():
    bands, per = choose_bands(0.8, 0.9999, 128)
    assert 1 - (1 - 0.8 ** per) ** bands >= 0.9999 and bands * per <= 128


@pytest.mark.parametrize("sizes", [{}, {"unit_shingles": 300, "unit_members": 2}])
def test_jaccard_join_against_all_pairs(spark, docs, rows, sizes):
    pairs, label = K.links(rows)
    n = collections.Counter(x for p in pairs for x in p)
    least = {}
    for i, r in enumerate(rows):
        least[label[i]] = min(least.get(label[i], (True, float('inf'))), (r[0] is not None, r[0] or 0))
    want = collections.Counter((r[0], least[label[i]][1] if least[label[i]][0] else None, n[i]) for i, r in enumerate(rows))
    got = jaccard_join.near_duplicates(docs, **sizes).collect()
    assert collections.Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == want
    assert len(pairs) > 20


def test_one_of_each(spark, docs, rows):
    _, label = K.links(rows)
    got = jaccard_join.one_of_each(docs)
    assert got.columns == docs.columns and got.count() == len(set(label))
    assert jaccard_join.near_duplicates(K.empty(spark)).count() == 0 and jaccard_join.one_of_each(K.empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).selectExpr("id + 1 as a", "id as b").unionByName(spark.createDataFrame([(500, 400)], "a long, b long"))
    assert {(r["node"], r["root"]) for r in jaccard_join.components(edges).collect()} == {(i, 0) for i in range(1, 201)} | {(500, 400)}


# --- op6

@pytest.mark.parametrize("sizes", [{}, {"task_words": 60}, {"window": 12, "anchor": 5}])
def test_span_dedup_against_all_windows(docs, rows, sizes):
    gone = K.removed(rows, sizes.get("window", 50))
    want = collections.Counter()
    for r, g in zip(rows, gone, strict=True):
        w = K.words(r[1])
        want[r[0], len(w), len(g), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in g).encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in span_dedup.dedup_spans(docs, **sizes).collect()) == want
    assert sum(map(len, gone)) > 200


def test_span_dedup_carries_columns(spark, docs):
    assert span_dedup.without_repeats(docs).columns == docs.columns
    assert span_dedup.dedup_spans(K.empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12), min_size=1, max_size=4), st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=20))
def test_matching_statistics(passages, text):
    runs = {tuple(p[i:j]) for p in passages for i in range(len(p)) for j in range(i + 1, len(p) + 1)}
    want = [max((n for n in range(i + 2) if tuple(text[i + 1 - n:i + 1]) in runs), default=0) for i in range(len(text))]
    assert span_dedup.SuffixAutomaton(passages).matching_statistics(text) == want


# --- op7

def test_decontamination_against_all_windows(spark, docs, rows):
    texts = [r[1] for r in rows if r[1] and len(K.words(r[1])) > 60]
    items = [" ".join(K.words(texts[0])[:30]), " ".join(K.words(texts[3])[5:17]), "one", "", None, "not in any text at all", " ".join(K.words(texts[0])[:30]).upper(),
             "A B c d", " ".join(K.words(texts[5])[3:60]), "w1 w2 w3 " * 20]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], BENCH)
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    want = collections.Counter()
    for r in rows:
        w, hit, names = fold(r[1]), set(), set()
        for k, t in enumerate(items):
            q = fold(t)
            n = min(13, len(q))
            phrases = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)} if q else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in phrases:
                    names.add(str(k))
                    hit.update(range(i, i + n))
        want[r[0], len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)] += 1
    for size in (2_000_000, 40):
        got = decontam.contamination(docs, bench, block_words=size).drop("rid").collect()
        assert collections.Counter(tuple(r) for r in got) == want
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if not k[5])
    none = spark.createDataFrame([], BENCH)
    assert decontam.contamination(K.empty(spark), bench).count() == 0 and decontam.contamination(docs, none).where("contaminated").count() == 0


def test_proximity(spark):
    index = spark.createDataFrame([(b"a", 1, 10), (b"b", 1, 14), (b"a", 2, 10), (b"b", 2, 40)], "term binary, rid long, pos int")
    wanted = spark.createDataFrame([(b"a", 0, 0, 0), (b"b", 0, 2, 0)], "term binary, item int, at int, start int")
    assert [(r["rid"], r["n_terms"]) for r in decontam.proximity(index, wanted, 3, 2).collect()] == [(1, 2)]


def test_proximity_matches_of_documents(spark, docs, rows):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    texts = [r[1] for r in rows if r[1] and len(K.words(r[1])) > 60]
    held = [fold(t) for t in texts]
    items = [[("absentword" if i % 13 == 6 else w) for i, w in enumerate(held[0][:39])], [x for i, w in enumerate(held[2][:26]) for x in ([w, "inserted"] if i % 13 == 5 else [w])],
             held[4][:20], held[6][:4], ["nowhere"] * 20, list(reversed(held[8][:26]))]
    bench = spark.createDataFrame([(i, " ".join(x), "x") for i, x in enumerate(items)], BENCH)
    folded = [fold(r[1]) for r in rows]
    df = collections.Counter(w for d in folded for w in set(d))

    def near(words, q):
        at = collections.defaultdict(list)
        for p, w in enumerate(words):
            at[w].append(p)
        n = min(13, len(q))
        for s in range(len(q) - n + 1) if n >= 5 else ():
            places = {}
            for i in range(s, s + n):
                if df[q[i]]:
                    places.setdefault(q[i], i)
            chosen = sorted(places.values(), key=lambda i: (df[q[i]], i))[:5]
            on = [(p - i, i) for i in chosen for p in at[q[i]]]
            if any(len({i for e, i in on if d <= e <= d + 2}) >= 4 for d, _ in on):
                return True
        return False

    want = collections.Counter((r[0], ",".join(str(k) for k, q in enumerate(items) if near(w, q))) for r, w in zip(rows, folded, strict=True))
    for size in (2_000_000, 40):
        got = decontam.contamination(docs, bench, block_words=size, near=True).collect()
        assert collections.Counter((r["doc_id"], ",".join(r["near_items"])) for r in got) == want
    assert any("0" in x for _, x in want) and any("1" in x for _, x in want)
    changed = [r for r in got if "0" in r["near_items"]]
    assert changed and all(r["n_hit"] == 0 and r["n_near"] == len(r["near_items"]) for r in changed if r["near_items"] == ["0"])
    assert decontam.contamination(docs, spark.createDataFrame([], BENCH), near=True).where("n_near > 0").count() == 0


def test_items_without_id_and_in_several_blocks(spark):
    body = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, body), (2, "other words " * 20)], "doc_id long, text string")
    words = body.split()
    bench = spark.createDataFrame([(None, " ".join(words[:15])), (None, "nothing like it"), (7, " ".join(words[12:30])), (7, " ".join(words[10:28]))], "item_id long, text string")
    for size in (2_000_000, 1):
        one, two = decontam.contamination(df, bench, block_words=size, near=True).orderBy("doc_id").collect()
        assert (one["n_hit"], one["n_items"], one["items_sha256"], one["contaminated"]) == (30, 2, hashlib.sha256(b"7").hexdigest(), True)
        assert (one["near_items"], one["n_near"]) == (["7"], 2) and (two["n_hit"], two["n_items"], two["n_near"]) == (0, 0, 0)
    only = decontam.contamination(df, bench.where("item_id is null")).orderBy("doc_id").collect()
    assert [(r["n_hit"], r["n_items"], r["contaminated"]) for r in only] == [(15, 1, True), (0, 0, False)]


# --- op8

def test_line_quality_against_python(spark, docs, rows):
    lines = lambda t: [x for x in (t or "").split("\n") if K.words(x)]
    norm = lambda x: " ".join(K.words(re.sub("[A-Z]", lambda m: m.group().lower(), x)))
    hosts, held = collections.defaultdict(set), collections.defaultdict(set)
    for r in rows:
        hosts[r[3]].add(r[1] or "")
        for x in lines(r[1]):
            held[r[3], norm(x)].add(r[1])
    bad = {k for k, v in held.items() if len(v) > 10 and len(v) > 0.1 * len(hosts[k[0]])}
    want = collections.Counter()
    for r in rows:
        t, w = r[1] or "", K.words(r[1])
        at = collections.defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i:i + 8])].append(i)
        rep = len({p for x in at.values() if len(x) > 1 for i in x for p in range(i, i + 8)})
        gone = sum(len(K.words(x)) for x in lines(t) if (r[3], norm(x)) in bad)
        base = len(w) < 20 or 100 * rep > 30 * len(w)
        left = len(w) - gone
        want[r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines(t)) - len(set(lines(t))), rep, gone, base, not base and left >= 20 and left >= len(w) / 2] += 1
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept"]
    assert collections.Counter(tuple(r) for r in line_quality.judge(docs).select(names).collect()) == want
    assert bad and any(k[6] for k in want)
    kept = line_quality.clean(docs)
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if k[8])
    assert kept.where(F.col("text").contains("all rights reserved") & (F.col("source") == "hot")).count() == 0
    assert line_quality.judge(K.empty(spark)).count() == 0 and line_quality.clean(K.empty(spark)).count() == 0


def test_line_quality_absolute_limit(spark):
    body = lambda i: " ".join(f"t{i}x{j}" for j in range(30))
    data = [(i, body(i) + ("\nshare this page" if i < 30 else ""), "crawl") for i in range(400)]  # 7.5 % of the host's documents
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    cut = lambda **limits: {r["doc_id"] for r in line_quality.judge(df, **limits).where("removed_words > 0").collect()}
    assert cut() == set() and cut(max_docs=30) == set() and cut(max_docs=29) == cut(max_docs=5) == set(range(30))


# --- op9

def test_license_scan_against_every_window(spark, docs):
    texts = {"long": " ".join(f"term{i}" for i in range(60)), "short": "Released under the MIT License", "tiny": "free", "none": ""}
    grown = texts["long"].split()
    grown[30] = "other"
    cases = [None, "", "words " * 4, "x " * 500 + texts["long"] + " y" * 500, "a " + " ".join(grown) + " b", " ".join(texts["long"].split()[:40]), "RELEASED under, the mit license.", "it is Free!", "x " * 30_000 + "released under the MIT license"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(cases)], "doc_id long, text string, license string")
    got = collections.Counter((r["doc_id"], r["license"]) for r in license_scan.scan(df, texts).collect())
    assert got == collections.Counter([(3, "long"), (4, "long"), (6, "short"), (7, "tiny"), (8, "short")])
    as_rows = license_scan.scan(df, spark.createDataFrame(list(texts.items()), "name string, text string"))
    assert collections.Counter((r["doc_id"], r["license"]) for r in as_rows.collect()) == got
    assert license_scan.scan(K.empty(spark)).count() == 0


def test_license_scan_knows_whole_texts_and_near_copies(spark):
    texts = license_texts.shipped()
    near = texts["GPL-2 (text)"].split()
    near[500] = "changed"
    cases = {"GPL-2 (text)": " ".join(near), "LGPL-2.1 (text)": texts["LGPL-2.1 (text)"], "MPL-2.0 (text)": texts["MPL-2.0 (text)"], "ISC (text)": texts["ISC (text)"],
             "Unlicense (text)": texts["Unlicense (text)"], "CC0-1.0 (text)": texts["CC0-1.0 (text)"], "BSD-3-Clause (text)": texts["BSD-3-Clause (text)"],
             "AGPL-3.0-or-later (header)": "Foo " + texts["AGPL-3.0-or-later (header)"], "CC-BY-SA-4.0": texts["CC-BY-SA-4.0"],
             "MIT": "x y distributed under the MIT license z", "Apache-2.0": "Licensed under the Apache Software License, version 2.0!", "CC-BY-NC-4.0": "Shared under CC BY-NC 4.0."}
    df = spark.createDataFrame([(k, "a b c " + v + " d e f") for k, v in cases.items()], "doc_id string, text string")
    got = collections.defaultdict(set)
    for r in license_scan.scan(df).collect():
        got[r["doc_id"]].add(r["license"])
    assert all(k in got[k] for k in cases), got
    assert [got[k] for k in ("MIT", "Apache-2.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0")] == [{"MIT"}, {"Apache-2.0"}, {"CC-BY-NC-4.0"}, {"CC-BY-SA-4.0"}]
    assert got["BSD-3-Clause (text)"] == {"BSD-3-Clause (text)", "BSD (text)"} and got["AGPL-3.0-or-later (header)"] == {"AGPL-3.0-or-later (header)"}
    assert license_scan.scan(spark.createDataFrame([(1, "Licensed under CC BY-SA 4.0; GNU General Public License")], "doc_id long, text string")).collect()[0]["license"] == "CC-BY-SA-4.0 (short)"


# --- op10

def test_mix_meets_the_repetition_limit_and_loses_nothing(docs, rows):
    got = mixing.mix(docs, repetition=2.0, min_block_tokens=200).collect()
    tokens, passed = collections.Counter(), collections.Counter()
    for r in rows:
        tokens[r[3]] += len(K.words(r[1]))
    for r in got:
        passed[r["source"]] += r["n_tokens"]
    rate = {s: passed[s] / tokens[s] for s in tokens}
    assert set(collections.Counter(r[0] for r in rows)) == {r["doc_id"] for r in got}
    assert abs(min(rate.values()) - 1) < 1e-9 and max(rate.values()) <= 2.2  # the last document of a pass may overshoot
    total = sum(tokens.values())
    alpha = mixing_exponent(tokens, 2.0)
    z = sum((t / total) ** alpha for t in tokens.values())
    assert all(abs(r["weight"] - (tokens[r["source"]] / total) ** alpha / z) < 1e-6 for r in got)
    assert all(0 <= r["mix_pos"] < 1 for r in got)


def mixing_exponent(tokens, limit):
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if (max(tokens.values()) / min(tokens.values())) ** (1 - mid) <= limit else (mid, hi)
    return hi


def test_entropy_target_and_budget(spark, docs, rows):
    sources = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 1)], "skey string, tokens long")
    a = mixing.exponent(sources, entropy_share=0.9)
    p = np.array([1000, 10, 1]) ** a
    p /= p.sum()
    assert abs(-(p * np.log(p)).sum() - 0.9 * np.log(3)) < 1e-6
    got = mixing.mix(docs, entropy_share=0.99, budget=3000, min_block_tokens=100).collect()
    longest = max(len(K.words(r[1])) for r in rows)
    assert abs(sum(r["n_tokens"] for r in got) - 3000) <= 3 * longest
    assert collections.Counter(tuple(r) for r in got) == collections.Counter(tuple(r) for r in mixing.mix(docs, entropy_share=0.99, budget=3000, min_block_tokens=100).collect())
    assert mixing.mix(K.empty(spark), repetition=2.0).count() == 0
    assert mixing.mixed_documents(docs, repetition=2.0).columns == docs.columns


def test_exponents_over_one_and_targets_out_of_reach(spark):
    made = lambda *tokens: spark.createDataFrame([(str(i), t) for i, t in enumerate(tokens)], "skey string, tokens long")
    share = lambda a: (lambda p: -(p * np.log(p)).sum() / np.log(3))(np.array([1000, 800, 500]) ** a / (np.array([1000.0, 800, 500]) ** a).sum())
    a = mixing.exponent(made(1000, 800, 500), entropy_share=0.5)
    assert a > 1 and abs(share(a) - 0.5) < 1e-6
    assert mixing.exponent(made(1000, 100), repetition=2.0, budget=2200) == pytest.approx(1) and mixing.exponent(made(5, 5), entropy_share=1.0) == 1
    assert mixing.exponent(made(5, 5), repetition=2.0, budget=20) == 1
    for sources, target in [(made(5, 5), {"entropy_share": 0.5}), (made(1000, 100), {"repetition": 2.0, "budget": 2300}), (made(5, 5), {"repetition": 2.0, "budget": 21}),
                            (made(9, 9, 1), {"entropy_share": 0.5}), (made(1000, 100), {"repetition": 0.5})]:
        with pytest.raises(ValueError):
            mixing.exponent(sources, **target)


# --- shared

def test_grouped_streams_over_batches(spark):
    df = spark.range(30_000).selectExpr("id % 7 as k", "id as v")
    got = grouped(df, ["k"], lambda g: {"k": g["k"][:1], "n": [len(g["v"])], "t": [sum(g["v"])]}, "k long, n long, t long").collect()
    assert sorted(tuple(r) for r in got) == [(k, len(range(k, 30_000, 7)), sum(range(k, 30_000, 7))) for k in range(7)]


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "shard"]
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, "w1 w2 w3", "x")], BENCH).write.parquet(f"{sf}/benchmark.parquet")
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    for i, (name, apply) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"] for r in frame.select("doc_id").collect()}
        apply(spark, frame, sf).write.parquet(f"{sf}/{i}")
        frame = spark.read.parquet(f"{sf}/{i}")
        after = {r["doc_id"] for r in frame.select("doc_id").collect()}
        assert after <= before and after
        if name in ("mix", "shard"):
            assert after == before
        if name != "shard":
            assert frame.columns == docs.columns
    assert frame.count() == corpus_pipeline.run(spark, sf).count()
    release(spark, STAGED)
