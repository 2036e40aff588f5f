"""Every operator against brute force or a round trip, and on nulls, empty and long texts, ties, repeats, empty
tables and clashing column names."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hirelens.llm import chat, langid, matroska, ordinal, packing, queries, simhash, token_store, toxicity, voronoi, wfst
from hirelens.llm.subwords import ChunkEncoder, encoder

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"

# Columns that clash with names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, code string, score string, uid string, held_out string, part string, length string, `_kept` string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", len(t or ""), *["x"] * 7) for i, t, g in rows], SCHEMA)


ODD = [None, "", " ", "\n", "?!", "a", "a  b\t\n", "é ﬁ 日本 😀", "x" * 5000, "<|endoftext|> <s>", "word " * 30_000, "\x00\x01", "same text here now", "same text here now"]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, [(i, t, None if i % 3 else "en") for i, t in enumerate(ODD)] + [(None, "no id at all", "en"), (3, "\n", "en")])


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, [])


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# 1


def brute_top(rows, k=5):
    good = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in good), default=0)
    good = [(i, np.pad(v, (0, width - len(v)))) for i, v in good]
    out = []
    for a, (i, q) in enumerate(good):
        if i % 50 == 0:
            found = sorted((-int(q @ v), j, b) for b, (j, v) in enumerate(good) if b != a)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j, _) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_top_k_is_exact(spark, seed):
    r = np.random.default_rng(seed)
    rows = [(i, (r.normal(size=8) * (1 + i % 3)).tolist()) for i in range(300)]
    rows += [(301, None), (302, [1.0, None]), (350, [float("nan")] * 8), (None, [1.0] * 8), (400, []), (450, [0.5, 0.25]), (100, rows[100][1]), (7, rows[8][1])]
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<double>, cell string, far int")
    got = sorted(tuple(x) for x in voronoi.top_k(df, F.col("vec_id") % 50 == 0, pivots=8).collect())
    assert got == brute_top(rows)


def test_top_k_splits_the_queries_of_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(voronoi, "GROUP", 8)
    r = np.random.default_rng(4)
    rows = [(i, (r.normal(size=8) + 20).tolist()) for i in range(0, 4000, 10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    top = voronoi.top_k(df, F.col("vec_id") % 50 == 0, pivots=2)
    assert sorted(tuple(x) for x in top.collect()) == brute_top(rows)
    keys = [x for x in top._jdf.queryExecution().analyzed().toString().splitlines() if "FlatMapCoGroupsInArrow" in x]
    assert keys and all(x.count("block#") == 2 for x in keys)


def test_top_k_clusters_prune_and_stay_exact(spark):
    r = np.random.default_rng(5)
    centre = r.normal(size=(6, 16)) * 20
    rows = [(i, (centre[i % 6 if i % 3 else 0] + r.normal(size=16) * 0.01).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(x) for x in voronoi.top_k(df, F.col("vec_id") % 50 == 0, pivots=6).collect()) == brute_top(rows)


def test_top_k_small_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(x) for x in voronoi.top_k(df, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert voronoi.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# 2


def test_wfst_equals_library(spark, corpus, odd):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for df in (corpus, odd):
        given = df.select("doc_id", "text").collect()
        got = wfst.encode(df, path).collect()
        want = sorted((str(r["doc_id"]), sp.encode(r["text"] or "")) for r in given)
        assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == want
        texts = sorted((str(r["doc_id"]), sp.decode(r["ids"])) for r in got)
        assert sorted((str(r["doc_id"]), r["text"]) for r in wfst.decode(spark.createDataFrame(got), path).collect()) == texts


def test_wfst_is_linear(corpus):
    """Long runs of blanks, a long word and a long text without blanks: like the library, in seconds."""
    path = P.path("piece_bpe_32k.model")
    import sentencepiece

    lib, t = sentencepiece.SentencePieceProcessor(model_file=path), wfst.transducer(path)
    r = np.random.default_rng(5)
    word = "".join(r.choice(list("etaoinshrdlu"), 100_000))
    for x in (" " * 100_000, "a" + " " * 4097 + "b", word, "\u4e2d\u6587" * 20_000, " " * 33 + "x" + " " * 5, word[:999] + " " * 17 + word[:31]):
        (body,) = t.encode_all([x])
        assert np.frombuffer(body, "<u4").tolist() == lib.encode(x)
    began = time.time()
    for x in (" " * 1_000_000, "".join(r.choice(list("etaoinshrdlu"), 1_000_000)), "\u4e2d" * 1_000_000):
        t.encode_all([x])
    assert time.time() - began < 90 and max(map(len, t.known)) <= wfst.KEPT


def test_unigram_path_is_shortest():
    def field(n, body):
        return bytes([n << 3 | 2, len(body)]) + body

    def piece(s, score, kind=1):
        import struct

        return field(1, field(1, s.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + bytes([3 << 3, kind]))

    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -4.0, 1), ("▁a", -2.2, 1), ("ba", -3.5, 1), ("aba", -9.0, 1)]
    t = wfst.Transducer(b"".join(piece(*p) for p in pieces) + field(2, bytes([3 << 3, 1])))
    score = {p: s for p, s, k in pieces if k == 1}

    def best(s):
        return max(((score[s[:n]] + (best(s[n:])[0] if s[n:] else 0.0), [s[:n], *(best(s[n:])[1] if s[n:] else [])]) for n in range(1, len(s) + 1) if s[:n] in score), default=(-1e9, []))

    for text in ("ab", "aba", "abab", "bababa", "a b ab"):
        ids = np.frombuffer(t.encode_all([text])[0], "<u4")
        assert sum(score[t.pieces[i]] for i in ids) == pytest.approx(best("▁" + text.replace(" ", "▁"))[0])


# 3


def test_chat_collapse(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", "b"), (4, 5, "user", None), (4, None, "system", "s"), (5, 0, "user", "a"), (5, 0, "user", "a"), (None, 0, "user", "a"), (6, 0, "user", "<|im_end|>")]
    long = [(9, n, "user", f"t{n}") for n in range(1000)] + [(8, n, "user", f"t{n}") for n in range(700)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows + long], "conv_id long, turn long, role string, text string, place string, h1 int")
    out = {}
    for r in sorted(chat.format_chats(df).collect(), key=lambda r: (r["conv_id"], r["segment"])):
        out[r["conv_id"]] = out.get(r["conv_id"], "") + r["rendered"]
    assert set(out) == {2, 4, 5, 6, 9}
    assert out[2] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert out[4].startswith("<|im_start|>system\ns<|im_end|>\n") and out[9].count("<|im_start|>") == 1000
    assert "< |im_end|>" in out[6]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_turns_without_numbers_are_many_groups(spark):
    """A conversation of 2000 turns without numbers, and one that is its prefix: in the order of role and text."""
    texts = sorted(f"{k % 97:02d} text {k}" for k in range(2000))
    rows = [(1, None, "user", t) for t in texts] + [(2, None, "user", t) for t in texts[:1500]] + [(3, None, "user", t) for t in texts[1:]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    placed = chat.placed_turns(df)
    assert placed.groupBy(*chat.PLACE).count().agg(F.max("count")).first()[0] < 200
    out = sorted(chat.format_chats(df).collect(), key=lambda r: (r["conv_id"], r["segment"]))
    assert {r["conv_id"] for r in out} == {1, 3}
    assert "".join(r["rendered"] for r in out if r["conv_id"] == 1) == "".join(f"<|im_start|>user\n{t}<|im_end|>\n" for t in texts)


# 4


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_store_round_trip(spark, odd, corpus, empty, tmp_path):
    path = P.path("byte_bpe_50k.json")
    t = encoder(path, True).tokenizer
    for k, df in enumerate((odd, corpus)):
        given = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), t.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in df.select("doc_id", "text").collect())
        got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_store.store_documents(df, path, path=f"{tmp_path}/{k}").collect())
        assert sorted((i, len(x), crc(x)) for i, x in given) == sorted((i, n, c) for i, _, n, c in got)
        assert [s for _, s, _, _ in got] == np.cumsum([0, *[n for _, _, n, _ in got]])[:-1].tolist()
        assert token_store.read_ids(spark, f"{tmp_path}/{k}", [1])[1] == dict(given)[1]
        stored = token_store.read_part(spark, f"{tmp_path}/{k}", "chunk")
        assert stored.count() == stored.select("address").distinct().count()
    assert token_store.store_documents(empty, path).count() == 0


def test_words_with_marks_are_merged_in_one_piece():
    """A chunk of a word, a line end before it and marks after it is looked up and merged once, not as two or three pre-tokens."""
    e = ChunkEncoder(P.path("byte_bpe_50k.json"), True)
    text = "Alpha, beta; gammä###\nDelta... the eñd"
    e.encode_all([text])
    assert set(e.known) == set(e.chunks(text))
    r = random.Random(3)
    parts = [*"abZéñüß'.,;:!?|#*% \n\t-_09\x00\xa0«×ªµ", "'s", "'ll", " \n", "\n\n", "ʼ", "ɐ", "日", "””,", "\r\n", "...", "###", "\nab"]
    batch = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    assert [np.frombuffer(x, e.dtype).tolist() for x in e.encode_all(batch)] == [x.ids for x in e.tokenizer.encode_batch(batch, add_special_tokens=False)]
    kind = dict.fromkeys(("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    joins = lambda *merge: not e._apart({**kind, "vocab": {"ÿ": 0}, "merges": [["a", "b"], ["Ġ", "a"], ["#", "#"], ["Ċ", "Ċ"], list(merge)]})
    assert [joins(*x) for x in (("a", ","), ("Ġa", "#b"), ("Ã©", "."), ("©", "."), ("Ċ", "a"), ("Ċ", "Ã"), ("a", "ÿ"))] == [True] * 7
    assert not joins("Ġ", ",") and not joins("âĢĿ", ",") and not joins("a", "c")


def test_chunks_follow_content():
    r = np.random.default_rng(3)
    shared = r.integers(0, 50_000, 20_000).astype("<u2")
    a, b = (np.r_[r.integers(0, 50_000, n).astype("<u2"), shared] for n in (777, 1234))

    def chunks(x):
        ends = token_store.cut_points(x)
        assert ends[-1] == len(x) and all(e - s <= token_store.MOST for s, e in zip([0, *ends], ends, strict=False))
        return {x[s:e].tobytes() for s, e in zip([0, *ends[:-1]], ends, strict=True)}

    assert len(chunks(a) & chunks(b)) > 0.6 * len(chunks(a))


def test_damaged_chunk_is_found(spark, corpus, tmp_path):
    path = str(tmp_path / "s")
    token_store.write_store(corpus.limit(20), path, P.path("byte_bpe_50k.json"))
    bad = token_store.read_part(spark, path, "chunk").withColumn("body", F.concat(F.substring("body", 1, 2), F.col("body"))).withColumn("kind", F.lit("chunk"))
    rest = token_store.read_part(spark, path, "recipe").withColumn("kind", F.lit("recipe"))
    bad.unionByName(rest).write.partitionBy("kind").parquet(path + "/raw2")
    (tmp_path / "s/raw").rename(tmp_path / "s/old")
    (tmp_path / "s/raw2").rename(tmp_path / "s/raw")
    with pytest.raises(Exception, match="address"):
        token_store.read_store(spark, path).collect()


def test_crc_arithmetic():
    a, b = b"hello", bytes(range(256)) * 9
    joined = token_store.times(token_store.power(np.array([len(b)])), np.array([zlib.crc32(a)], np.uint32))[0] ^ zlib.crc32(b)
    assert joined == zlib.crc32(a + b)


@pytest.mark.parametrize(("name", "keeps"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunked_encoding_equals_whole(name, keeps):
    e = encoder(P.path(name), keeps)
    r = random.Random(4)
    pieces = ["a", "The", " ", "  ", "\n", "\n\n", "\t", "'s", "'LL", "12", "é", "é", "日本", "😀", ".", ",", "|", "_", "²", "İ", "Σ", "　", "\x85", "\x1c", "x" * 40]
    made = ["".join(r.choices(pieces, k=r.randint(0, 12))) for _ in range(3000)] + [x for x in ODD if x]
    for text, body in zip(made, e.encode_all(made), strict=True):
        assert np.frombuffer(body, e.dtype).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


# 5


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(codes, ids, limit=2):
    label = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= limit:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return {i: min((ids[k] for k in range(len(ids)) if label[k] == label[n] and ids[k] is not None), default=None) for n, i in enumerate(ids)}


def test_near_duplicates(spark, corpus, odd, empty):
    for df in (corpus, odd):
        rows = df.select("doc_id", "text").collect()
        codes = [brute_fingerprint(r["text"]) for r in rows]
        want = brute_components(codes, [r["doc_id"] for r in rows])
        got = simhash.near_duplicates(df).collect()
        assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in got) == sorted((str(r["doc_id"]), f"{c:016x}") for r, c in zip(rows, codes, strict=True))
        assert all(r["component_id"] == want[r["doc_id"]] for r in got)
    assert simhash.near_duplicates(empty).count() == 0


def test_gray_index_finds_all_links_across_parts(spark, monkeypatch):
    r = np.random.default_rng(2)
    base = r.integers(0, 2**63, 60, np.int64)
    codes = sorted({int(b) ^ int(x) for b in base for x in [0, 1, 6, 1 << 62, (1 << 40) | 1, 0b111, 1 << 13]})
    monkeypatch.setattr(simhash, "PART", 20)
    df = spark.createDataFrame([(c,) for c in codes], "code long")
    got = {r["u"]: r["v"] for r in simhash.components(simhash.links(df)).collect()}
    label = brute_components([c & (2**64 - 1) for c in codes], codes)
    assert {c: got.get(c, c) for c in codes} == label


def test_codes_visit_the_parts_that_may_hold_a_link():
    r = np.random.default_rng(2)
    codes = np.unique(r.integers(0, 1 << 64, 4000, np.uint64))
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    codes = codes[np.argsort(rank)]
    cuts = np.arange(0, len(codes), 7)
    both, either = np.bitwise_and.reduceat(codes, cuts), np.bitwise_or.reduceat(codes, cuts)
    part = np.arange(len(codes)) // 7
    row, to = simhash.later_parts(simhash.part_tree(both, either), codes, part, 2)
    near = np.bitwise_count((codes[:, None] ^ both) & ~(both ^ either)) <= 2
    want = set(zip(*np.nonzero(near & (np.arange(len(cuts)) > part[:, None])), strict=True))
    assert set(zip(row, to, strict=True)) == want
    assert simhash.later_parts(simhash.part_tree(both[:1], either[:1]), codes[:7], part[:7], 2)[0].size == 0


def test_long_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "u long, v long")
    assert {(r["u"], r["v"]) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(1, 61)}


def test_keep_one_keeps_columns_and_one_row(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(12) == 1 and 13 not in ids and ids.count(0) == 1 and ids.count(None) == 1


def test_keep_one_with_repeated_and_null_ids(spark):
    word = lambda k: " ".join(hashlib.md5(f"{k} {i}".encode()).hexdigest()[:6] for i in range(200))
    a, b, c, d = (word(k) for k in "abcd")
    near = next(t for t in (f"{c} {k}" for k in range(500)) if 0 < (brute_fingerprint(t) ^ brute_fingerprint(c)).bit_count() <= simhash.LIMIT)
    assert len(set(brute_components([brute_fingerprint(t) for t in (a, b, c, d, near)], [0, 1, 2, 3, 4]).values())) == 4
    got = simhash.keep_one(docs_of(spark, [(3, a, "x"), (5, a, "x"), (5, b, "x"), (7, d, "x"), (7, d, "x"), (None, c, "x"), (None, near, "x"), (None, c, "x"), (None, d, "x")])).collect()
    kept = [(r["doc_id"], r["text"]) for r in got]
    assert len(kept) == 4 and {(3, a), (5, b), (7, d)} < set(kept)
    assert [t in (c, near) for i, t in kept if i is None] == [True]


# 6


def test_ordinal_grades(spark, corpus, odd, empty):
    r = random.Random(1)
    words = [["bad", "awful", "junk"], ["fair", "plain", "so"], ["fine", "great", "clear"]]
    rows = [(i, " ".join(r.choices(words[i % 3], k=30)), "en") for i in range(300)]
    df, ratings = docs_of(spark, rows), spark.createDataFrame([(i, i % 3) for i in range(300)] + [(0, 0), (None, 2), (9, None)], "doc_id long, grade int")
    out = by_id(ordinal.rate(df, ratings, [0, 1, 2]))
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i]["held_out"] for i in held)
    assert sum(abs(out[i]["expected_grade"] - i % 3) < 0.5 for i in held) >= 0.95 * len(held)
    assert ordinal.rate(odd, ratings, [0, 1, 2]).count() == odd.count()
    assert ordinal.rate(empty, ratings, [0, 1, 2]).count() == 0
    assert {x["selected"] for x in ordinal.rate(df, ratings.limit(0), [0, 1, 2]).collect()} == {0}


def test_ordinal_scores_equal_feature_products():
    m = ordinal.fit(np.random.default_rng(0).random((40, ordinal.BUCKETS), np.float32), np.arange(40) % 3, [0, 1, 2])
    assert (np.diff(m.thresholds) > 0).all()
    batch = [None, "", "a", "ab", *ODD[5:]]
    assert np.allclose(m.scores(batch), [ordinal.features(t).astype(float) @ m.weights for t in batch], atol=1e-4)


# 7


def test_language(spark, odd, empty):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out, lang = by_id(langid.identify(df)), {r["doc_id"]: r["lang"] for r in df.collect()}
    held = [i for i in out if out[i]["held_out"]]
    assert held == [i for i in out if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(out[i]["lang_pred"] == lang[i] for i in held) >= 0.97 * len(held)
    got = langid.identify(odd).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["lang_pred"] == "und" for r in got if r["doc_id"] in (0, 1, 2, 3, 4))
    assert {r["lang_pred"] for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(empty).count() == 0


def test_profiles_are_bundles_of_bound_letters(monkeypatch):
    def slow(text, d=64):
        import re

        s = re.sub(r"[^\W\d_]", lambda m: m[0], "".join(c if c.isalpha() else " " for c in f" {text.lower()} "))
        s = re.sub(" +", " ", s)
        v = lambda c: langid.letter_vector(ord(c), d).astype(int)
        return sum((np.roll(v(a), 2) * np.roll(v(b), 1) * v(c) for a, b, c in zip(s, s[1:], s[2:], strict=False)), np.zeros(d))

    batch = ["Hello, wörld", "a", "ab  cd", "x1y", "日本語 text"]
    got, _ = langid.profiles(batch, 64)
    for t, g in zip(batch, got, strict=True):
        assert np.allclose(langid._unit(slow(t)[None])[0] @ langid._unit(g[None])[0], 1, atol=0.05), t
    whole, _ = langid.profiles(["abc def " * 500], 64)
    monkeypatch.setattr(langid, "SEGMENT", 100)
    parts, _ = langid.profiles(["abc def " * 500], 64)
    assert np.allclose(whole, parts, atol=whole.max() * 0.1)


def test_profiles_of_many_letters_stay_small():
    """A million CJK characters of 20,000 kinds, within 500 MB."""
    import tracemalloc

    r = np.random.default_rng(4)
    text = "".join(map(chr, r.integers(0x4E00, 0x4E00 + 20_000, 1_000_000)))
    tracemalloc.start()
    vectors, n = langid.profiles([text], langid.DIMENSIONS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n[0] == 1_000_000 and np.linalg.norm(vectors[0]) > 0 and peak < 500e6


def test_language_gate_rejects_what_was_not_learned(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    r = np.random.default_rng(3)
    made = lambda letters, words: " ".join("".join(r.choice(list(letters), int(r.integers(2, 9)))) for _ in range(words))
    alphabets = {"cyrillic": "абвгдежзийклмнопрстуфхцчшщыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω", "han": [chr(0x4E00 + 7 * k) for k in range(600)], "latin": "abcdefghijklmnopqrstuvwxyz", "a-f": "abcdef"}
    odd = [(-1 - i, made(a, w), None) for i, (a, w) in enumerate((a, w) for a in alphabets.values() for w in (60, 300) for _ in range(25))]
    short = [(10**9 + i, t, None) for i, t in enumerate(["the man and the other", "que la de los en el", "und der die das ist", "les et des pour que la"])]
    out = {x["doc_id"] for x in langid.keep_known(docs.unionByName(spark.createDataFrame(odd + short, docs.schema)), corpus_pipeline.LEAST_COSINE).collect()}
    assert sum(i in out for i, _, _ in odd) <= 0.02 * len(odd)
    assert all(i in out for i, _, _ in short)
    lettered = {x["doc_id"] for x in docs.collect() if any(c.isalpha() for c in x["text"] or "")}
    assert len(lettered & out) >= 0.99 * len(lettered)


def test_language_model_and_gate_come_from_every_document(spark):
    """More documents than 2000 learned and 500 held out a language, whatever the layout."""
    r = np.random.default_rng(5)
    rows = [(i, " ".join("".join(r.choice(list(letters), int(r.integers(2, 7)))) for _ in range(int(r.integers(2, 7)))), lang) for i, (letters, lang) in enumerate([("abcdefgh", "x"), ("fghijkl", "y")] * 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = [x for n in (3, 7) for langs, p in [langid.learn(docs.repartition(n))] for x in (langs, p, langid.calibrate(docs.repartition(n), langs, p, 0.0))]
    assert out[0] == out[3] == ["x", "y"] and np.array_equal(out[1], out[4]) and np.abs(out[2] - out[5]).max() <= 2 / langid.STEPS
    held = lambda i: zlib.crc32(str(i).encode()) % langid.PARTS == langid.HELD_OUT
    for k, lang in enumerate(out[0]):
        vectors, _ = langid.profiles([t for i, t, g in rows if g == lang and not held(i)])
        whole = langid._unit(vectors).sum(0)
        assert np.allclose(out[1][k], whole / np.linalg.norm(whole), atol=1e-5)
        parts = [t[:n] for i, t, g in rows if g == lang and held(i) for n in [*[b for b in langid.BEGINNINGS if b < len(t)], len(t)]]
        _, score, n, kind = langid._nearest(parts, out[1])
        least = 0.0
        for c in range(langid.CLASSES):
            own = score[(kind == c) & (n > 0)]
            least = max(least, langid.SHARE * np.quantile(own, langid.QUANTILE)) if len(own) >= langid.FEWEST else least
            assert abs(out[2][k, c] - least) <= 2 / langid.STEPS


# 8


def test_toxicity_separates_and_generalises(spark, odd, empty):
    df, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out, marks = by_id(toxicity.score(df, labels)), {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in marks if out[i]["held_out"]]
    toxic, said = [i for i in held if marks[i]], [i for i in held if out[i]["predicted"]]
    caught = sum(marks[i] for i in said)
    assert len(toxic) >= 10 and caught >= 0.75 * len(toxic) and caught >= 0.85 * len(said)  # recall and precision
    got = toxicity.score(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(empty, labels).count() == 0
    assert {r["score"] for r in toxicity.score(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.keep_clean(odd, labels).columns == odd.columns


def test_gradient_is_right():
    net = toxicity.Network({b"the": 1, b"of": 2}, np.array([0.3, -0.2], np.float32))
    words, ids, _ = toxicity.windows_of([b"the cat sat of mat".split() * 9])
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    y = np.arange(len(ids)) % 2.0
    g = net.gradient(words, ids, y, np.full(len(ids), 1 / len(ids)))
    for k in g:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        loss = []
        for step in (1e-3, -2e-3):
            net.p[k][at] += step
            q = net.forward(net.inputs(words), ids)
            loss.append(-np.mean(y * np.log(q) + (1 - y) * np.log(1 - q)))
        net.p[k][at] += 1e-3
        assert (loss[0] - loss[1]) / 2e-3 == pytest.approx(g[k][at], rel=1e-2, abs=1e-5)


def test_windows_cover_every_word():
    documents = [[b"w%d" % i for i in range(n)] for n in (0, 1, 31, 32, 33, 100, 401)]
    words, ids, owner = toxicity.windows_of(documents)
    for k, d in enumerate(documents):
        seen = {words[i] for i in ids[owner == k].ravel() if i >= 0}
        assert seen == set(d) and (owner == k).sum() >= 1


# 9


def test_packing_is_gapless_and_tight(spark, odd, corpus, empty):
    path = P.path("word_bpe_49k.json")
    t = encoder(path, False).tokenizer
    for df in (odd, corpus):
        rows = packing.pack_documents(df, path).collect()
        given = [t.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in df.collect()]
        assert sum(r["length"] for r in rows) == sum(map(len, given))
        want = sorted((k, at, len(x[at : at + 4096]), crc(x[at : at + 4096])) for x in given for k, at in enumerate(range(0, len(x), 4096)))
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
        by = {}
        for r in rows:
            by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for s in by.values():
            s.sort()
            assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:], strict=False)) and s[-1][0] + s[-1][1] <= 4096
        assert len(by) <= -(-sum(map(len, given)) // 4096) + 1
    assert packing.pack_documents(empty, path).count() == 0


def histogram(lengths):
    h = {}
    for x in np.clip(np.asarray(lengths).astype(int), 1, 4096).tolist():
        h[x] = h.get(x, 0) + 1
    return h


R = np.random.default_rng(1)
HISTOGRAMS = {
    "lognormal": histogram(R.lognormal(6.8, 0.9, 3000)),
    "1000 to 3000": histogram(R.integers(1000, 3001, 30000)),
    "1300 to 1500": histogram(R.integers(1300, 1501, 30000)),
    "1 to 60": histogram(R.integers(1, 61, 300000)),
    "three lengths": {1366: 3000, 1365: 3000, 2000: 500},
    "ten": histogram(R.lognormal(6.8, 0.9, 10)),
    "full and one": {4096: 50, 7: 1},
}


@pytest.mark.parametrize("name", list(HISTOGRAMS))
def test_plan_near_its_bound(name):
    h = HISTOGRAMS[name]
    plan, used = packing.solve(h), {}
    for times, items in plan.groups:
        assert sum(x * k for x, k in items) <= 4096 and times > 0
        for x, k in items:
            used[x] = used.get(x, 0) + times * k
    need = np.zeros(4097, int)
    need[list(h)] = list(h.values())
    assert used == h and plan.lower_bound <= plan.sequences <= min(plan.lower_bound * 1.01 + 1, sum(n for n, _ in packing.best_fit(need, 4096)))
    assert plan.sequences == sum(n for n, _ in plan.groups) and plan.lower_bound >= sum(x * n for x, n in h.items()) / 4096


def test_small_plans():
    assert packing.solve({}).sequences == 0
    assert packing.solve({3000: 7}).sequences == 7 == packing.solve({3000: 7}).lower_bound


def test_bound_holds_for_every_packing():
    """Against the best packing of few pieces, found by trying all."""

    def fewest(pieces):
        best = [len(pieces)]

        def go(k, rooms):
            if len(rooms) >= best[0]:
                return
            if k == len(pieces):
                best[0] = len(rooms)
                return
            for i in range(len(rooms)):
                if rooms[i] >= pieces[k]:
                    go(k + 1, [*rooms[:i], rooms[i] - pieces[k], *rooms[i + 1 :]])
            go(k + 1, [*rooms, 20 - pieces[k]])

        go(0, [])
        return best[0]

    r = np.random.default_rng(3)
    for _ in range(30):
        pieces = sorted(r.integers(1, 21, 8).tolist(), reverse=True)
        h = {}
        for x in pieces:
            h[x] = h.get(x, 0) + 1
        plan = packing.solve(h, 20, 40)
        assert plan.lower_bound <= fewest(pieces) <= plan.sequences <= fewest(pieces) + 1


def test_knapsack_is_optimal():
    best = packing.knapsack(np.array([3, 7, 11]), np.array([3.1, 7.5, 11.2]), 30)
    for c in range(31):
        assert best[c] == pytest.approx(max(a * 3.1 + b * 7.5 + d * 11.2 for a in range(11) for b in range(5) for d in range(3) if 3 * a + 7 * b + 11 * d <= c))


def test_packing_spreads_equal_pieces(spark, monkeypatch):
    """Copies of one document and full pieces, over groups of a few rows."""
    monkeypatch.setattr(packing, "GROUP", 3)
    given = [(7, "a b c")] * 40 + [(None, "x " * 5000)] * 5 + [(None, None)] * 3
    rows = packing.pack_documents(spark.createDataFrame(given, "doc_id long, text string").repartition(4), P.path("word_bpe_49k.json")).collect()
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert len(rows) == 40 + 10 + 3
    for s in by.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:], strict=False)) and s[-1][0] + s[-1][1] <= 4096


# 10


def test_media_round_trip(spark, odd, empty):
    out = matroska.media_features(odd).collect()
    given = [(r["doc_id"], (r["text"] or "").encode()) for r in odd.collect()]
    want = sorted((str(i), len(b), len(p := matroska.padded(b)), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])) for i, b in given)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in out) == want
    assert matroska.media_features(empty).count() == 0
    table = matroska.packet_table(matroska.to_media(odd.where("doc_id = 10"))).orderBy("packet").collect()
    assert [r["time_ns"] for r in table] == [n * 24_000_000 for n in range(len(table))]
    assert {r["byte_end"] - r["byte_start"] for r in table} == {192}


def test_cues_point_at_clusters():
    m = matroska.write_media(matroska.padded(bytes(range(256)) * 3000))
    p = matroska.read_packets(m)
    assert len(p.cues) == len(p.clusters) > 1
    assert all(m[at : at + 4] == bytes.fromhex("1f43b675") for _, at in p.cues)


def test_all_lacings_unknown_sizes_and_block_groups():
    frames = [b"a" * 300, b"b" * 5, b"c" * 40]
    xiph = b"\x82" + bytes([255, 45, 5])
    first, second = (300 | 0x4000).to_bytes(2, "big"), ((5 - 300 + 0x1FFF) | 0x4000).to_bytes(2, "big")
    block = lambda flags, body: b"\x81\x00\x05" + bytes([flags]) + body
    parts = [matroska.element(matroska.SIMPLE_BLOCK, block(0x02, b"\x02" + xiph[1:] + b"".join(frames))), matroska.element(matroska.BLOCK_GROUP, matroska.element(matroska.BLOCK, block(0x06, b"\x02" + first + second + b"".join(frames)))), matroska.element(matroska.SIMPLE_BLOCK, block(0x04, b"\x01" + b"xxyy")), matroska.element(matroska.SIMPLE_BLOCK, block(0x00, b"z"))]
    cluster = matroska.CLUSTER.to_bytes(4, "big") + b"\xff" + matroska.number(matroska.TIMESTAMP, 7) + b"".join(parts)
    data = matroska.element(matroska.EBML, b"") + matroska.SEGMENT.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + cluster + matroska.element(matroska.CUES, b"")
    p = matroska.read_packets(data)
    assert [data[s:e] for s, e in zip(p.start, p.end, strict=True)] == frames * 2 + [b"xx", b"yy", b"z"]
    assert set(p.time) == {12_000_000}
    with pytest.raises(ValueError):
        matroska.read_packets(data[:-20] + b"\xff")


# Queries and pipeline


def test_queries_agree_with_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("embeddings", "conversations", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in queries.ORACLES.items():
        got = queries.QUERIES[name](spark, SF)
        columns = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(map(tuple, got.select(columns).collect())) == sorted(want), name


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "simhash_near_dedup", "best_fit_packing"]
    rows = corpus_pipeline.run(spark, SF).collect()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = {r["doc_id"] for r in toxicity.score(docs, labels).collect() if r["score"] < 0.5}
    left = docs.where(F.col("doc_id").isin(list(clean)))
    known = {r["doc_id"] for r in langid.identify(left).collect() if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.LEAST_COSINE}
    texts = [(r["doc_id"], brute_fingerprint(r["text"])) for r in left.collect() if r["doc_id"] in known]
    firsts = set(brute_components([c for _, c in texts], [i for i, _ in texts]).values())
    assert {r["doc_id"] for r in rows} == firsts


def written(spark, folder, docs, labels):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_on_odd_rows(spark, corpus, odd, tmp_path):
    import corpus_pipeline

    wide = corpus.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"), *[F.lit("x").alias(c) for c in odd.columns[5:]])
    moved = odd.withColumn("doc_id", F.col("doc_id") + 10_000)
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumns({c: F.lit("x") for c in ("text", "value", "score")})
    sf_dir = written(spark, tmp_path / "odd", wide.unionByName(moved).unionByName(wide.where("doc_id < 20")), labels.unionByName(labels.limit(50)))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns, name
        before, after = [sorted(map(str, x.collect())) for x in (docs, kept)]
        assert after and not set(after) - set(before) and len(after) <= len(before), name
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    texts = [r["text"] for r in docs.collect()]
    assert not [t for t in texts if not t or not any(c.isalpha() for c in t)] and len(set(texts)) == len(texts)
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.collect()}
    assert all(0 <= r["offset"] and r["offset"] + r["length"] <= 4096 for r in pieces)


def test_pipeline_on_nothing(spark, odd, tmp_path):
    import corpus_pipeline

    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert corpus_pipeline.run(spark, written(spark, tmp_path / "empty", odd.limit(0), none)).count() == 0
    # Without labels nothing is toxic; of the odd rows those in letters are left.
    docs = spark.createDataFrame([(1, "the cat sat on the mat and then it slept for hours", "en", "s", 50)], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.remove_toxic(spark, docs, written(spark, tmp_path / "unlabelled", docs, none)).count() == 1


def test_labels_with_clashing_columns(spark, corpus):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clashing = labels.withColumns({c: F.lit("x") for c in ("text", "value", "lang", "score", "doc")})
    assert by_id(toxicity.score(corpus, labels)) == by_id(toxicity.score(corpus, clashing))
    graded = [x.withColumn("grade", F.when(F.col("quality") == 0, 0).otherwise(2 - F.col("toxic"))) for x in (labels, clashing)]
    first, second = [by_id(ordinal.rate(corpus, x, [0, 1, 2])) for x in graded]
    assert first == second
