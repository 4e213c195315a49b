"""Text operators against plain versions, and their edge cases."""

import hashlib
import itertools
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankbeam.llm import bpe, jaccard_join, langid, mixing, pii, quality, token_store, toxicity
from rankbeam.session import scratch_path
from tests_llm_plain import plain_components, plain_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, very long, repeated and tied rows; a clashing extra column."""
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, "a b c d e f g"), (4, "a b c d e f g"),
            (5, "a b c d e f g"), (6, "x" * 200_000), (7, "one two"), (8, "1 2 3 4"), (None, "q w e r t y"),
            (9, "é😀 ٣ Ωmega " * 3000), (10, None)]
    return spark.createDataFrame([(i, t, "en" if t else None, "s", None) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, score string")


def _vocab():
    import public_tokenizers

    return public_tokenizers.path


# -- PII ---------------------------------------------------------------------------

def test_pii_base_spans_equal_plain_regexes(spark, docs, odd):
    tricky = spark.createDataFrame([
        (-1, "a@b.c_d@e.f x1.2.3.4.5.6.7.8 é😀 +1 (555) 123-4567"), (-2, "4111 1111 1111 1111"),
        (-3, "1" * 30_000), (-4, "256.1.1.1 0255.1.1.1 +1234567 +123456789012345 +1234567890123456"),
        (-5, "x@y.z " * 2000), (-6, "a@b.c.d..e@f-g.h")], "doc_id long, text string")
    for d in (docs.select("doc_id", "text"), odd.select("doc_id", "text"), tricky):
        texts = sorted((r["doc_id"] or -99, r["text"] or "") for r in d.collect())
        got = sorted((r["doc_id"] or -99, r["base_sha256"], r["n_email"] + r["n_ip"] + r["n_card"] +
                      r["n_phone"]) for r in pii.digest(pii.find(d)).collect())
        want = sorted((i, hashlib.sha256(",".join(s).encode()).hexdigest(), len(s))
                      for i, t in texts for s in [plain_spans(t)])
        assert got == want


def test_pii_checksums_and_context(spark):
    d = spark.createDataFrame([
        (1, "iban DE89 3704 0044 0532 0130 00."), (2, "DE89 3704 0044 0532 0130 01"),
        (3, "my ssn 123-45-6789"), (4, "part 123-45-6789")], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find(d)).collect()}
    assert got == {1: "iban:5:32", 2: "", 3: "ssn:7:18", 4: ""}


def test_pii_ibans_before_capitals_and_digits(spark):
    texts = {
        1: "DE89370400440532013000 BIC COBADEFFXXX", 2: "DE89 3704 0044 0532 0130 00 Then",
        3: "x DE89370400440532013000 GB29 NWBK 6016 1331 9268 19 REF 12", 4: "DE89370400440532013000COBADEFF",
        5: "aDE89370400440532013000", 6: "DE89 3704 0044 0532 0130 01 BIC", 7: "MT84 MALT 0110 0001 2345 MTLC AST0 01S A",
        8: "RE12 DE89 3704 0044 0532 0130 00", 9: "é😀 NO93 8601 1117 947 I"}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: [x for x in r["spans"].split(",") if x.startswith("iban")]
           for r in pii.digest(pii.find(d)).collect()}
    assert got == {1: ["iban:0:22"], 2: ["iban:0:27"], 3: ["iban:2:24", "iban:25:52"], 4: [], 5: [], 6: [],
                   7: ["iban:0:38"], 8: ["iban:5:32"], 9: ["iban:3:21"]}
    out = {r["doc_id"]: r["text"] for r in pii.redact(d).collect()}
    assert out[1] == "[IBAN] BIC COBADEFFXXX" and out[2] == "[IBAN] Then"


def test_pii_redaction_merges_overlaps_and_keeps_rows(spark, odd):
    d = spark.createDataFrame([(1, "mail a@1.2.3.4 end", 18), (2, None, None)],
                              "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.redact(d).collect()}
    assert got == {1: ("mail [EMAIL] end", 16), 2: (None, None)}
    out = pii.redact(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    many = spark.createDataFrame([(1, "x@y.z " * 1000)], "doc_id long, text string")
    assert pii.redact(many).first()["text"] == "[EMAIL] " * 1000


# -- language ------------------------------------------------------------------------

def test_language_held_out_and_edges(spark, docs, odd):
    train = docs.where("crc32(cast(doc_id as string)) % 3 <> 1")
    model = langid.fit(train)
    held = langid.predict(docs.where("crc32(cast(doc_id as string)) % 3 = 1"), model)
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count()
    rows = langid.predict(odd, model).collect()
    assert "score" in rows[0].asDict() and len(rows) == odd.count()
    for r in rows:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        assert 0 <= r["score"] <= 1
    texts = [r["text"] for r in docs.collect()] + [r["text"] for r in rows]
    fast = [langid._Scorer(model)(t)[0] for t in texts]
    assert fast == langid.brute_force(model, texts)["lang_pred"].tolist()
    none = langid.fit(train.limit(0))
    assert langid._Scorer(none)("abc") == ("und", 0.0)
    assert langid.predict(docs.limit(0), model).count() == 0
    kept = langid.keep_identified(docs, langid.predict(docs, model))
    assert kept.columns == docs.columns and kept.count() == docs.count()


# -- near duplicates -------------------------------------------------------------------

def _key(x):
    return tuple((v is None, v or 0) for v in x)


def test_jaccard_components_equal_all_pairs(spark, docs, odd):
    for d in (docs.select("doc_id", "text"), odd):
        rows = [(r["doc_id"], r["text"]) for r in d.collect()]
        got = [tuple(r) for r in jaccard_join.components_of(d).collect()]
        assert sorted(got, key=_key) == sorted(plain_components(rows), key=_key)
    assert jaccard_join.components_of(docs.limit(0)).count() == 0


def test_jaccard_crowded_group_of_near_copies(spark):
    """More near copies than a token's pairing bound: clusters are compared in blocks."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        w = list(base)
        for k in rng.choice(len(w), 1 + i % 5, replace=False):
            w[k] = f"n{i}x{k}"
        rows.append((i, " ".join(w)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard_join.components_of(d).collect())
    assert got == sorted(plain_components(rows))
    kept = jaccard_join.keep_one(d)
    assert kept.count() == len({c for _, _, c in got})


def test_jaccard_orders_are_intersected_before_texts_are_read(spark):
    """Pairs that share their 3 rarest of 20 shingles meet in the first order's prefixes;
    those that do not meet under both hash orders go without a look at a text."""
    import pyarrow as pa

    texts = []
    for p in range(60):
        same = [f"s{p}x{i}" for i in range(7)]
        texts += [" ".join(same + [f"u{p}y{side}z{i}" for i in range(17)]) for side in (0, 1)]
    sets = jaccard_join.shingle_sets(pa.array(texts))
    levels = np.ones(1 << 16, np.uint8)
    for x, y in zip(sets[::2], sets[1::2], strict=True):
        levels[(np.intersect1d(x, y) >> np.uint64(48)).astype(np.int64)] = 0
    shared = spark.sparkContext.broadcast(levels)
    d = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "node long, comp long, text string")
    prefixes = jaccard_join._prefixes(d, 5, 80, 16, shared)
    index = {r["node"]: set(r["tokens"]) for r in prefixes.collect()}
    assert all(len(v) == 5 for v in index.values())
    assert all(len(index[i] & index[i + 1]) >= 2 for i in range(0, 120, 2))
    pairs = spark.createDataFrame([(i, i + 1, 20) for i in range(0, 120, 2)], "a long, b long, nb int")
    got = {r["a"] for r in jaccard_join._intersect(pairs, prefixes).collect()}
    seeds = jaccard_join._order_seeds()
    want = {i for i in range(0, 120, 2) if jaccard_join._meets(sets[i], sets[i + 1], 80, seeds)}
    assert got == want and len(got) < 30
    plan = jaccard_join._intersect(pairs, prefixes)._jdf.queryExecution().analyzed().toString()
    assert "text" not in plan.split("MapInArrow")[0]


def test_jaccard_token_levels_tell_frequent_tokens_from_crowded_buckets(spark):
    """15 tokens a bucket, as in a table of some 2 GB: words of 12 texts still leave the prefixes."""
    texts = [" ".join([f"w{i}x{j}" for j in range(4000)] + [f"shared{j}" for j in range(40) if j % 20 == i % 20])
             for i in range(240)]
    d = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    own = np.concatenate(jaccard_join.shingle_sets(pa.array(
        [" ".join(f"w{i}x{j}" for j in range(4000)) for i in range(240)]), 1))
    shared = jaccard_join.shingle_sets(pa.array([" ".join(f"shared{j}" for j in range(40))]), 1)[0]
    bits, levels = jaccard_join._token_levels(d, 1, 0)
    assert bits == 16 and len(levels) == 1 << 16
    at = lambda x: levels[(x >> np.uint64(64 - bits)).astype(np.int64)]
    assert at(shared).min() >= 3 and (at(own) == 0).mean() > 0.99
    for s in jaccard_join.shingle_sets(pa.array(texts[:20]), 1):
        assert not np.isin(jaccard_join._rare_first(s, 800, bits, levels), shared).any()


@pytest.mark.parametrize("total", [0, 5 << 20])
def test_jaccard_token_levels_equal_plain_counts(spark, total):
    rng = np.random.default_rng(11)
    texts = [" ".join(f"v{k}" for k in rng.zipf(1.3, 60) % 5000) for _ in range(300)] + ["", None]
    d = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    bits, levels = jaccard_join._token_levels(d, 2, total)
    key = (total >> 20).bit_length() + 24
    cells, counts = np.unique(np.concatenate(jaccard_join.shingle_sets(pa.array(texts), 2)) >> np.uint64(64 - key),
                              return_counts=True)
    want = np.zeros(1 << bits, np.uint8)
    np.maximum.at(want, cells >> np.uint64(key - bits), np.log2(counts).astype(np.uint8))
    assert levels.tolist() == want.tolist() and levels.max() > 3
    none = jaccard_join._token_levels(d.limit(0), 2, total)[1]
    assert len(none) == 1 << bits and not none.any()


def test_jaccard_packed_cells():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3000):
        cells = np.sort(rng.integers(0, 1 << 24, n).astype(np.uint32))
        assert (jaccard_join._unpack(jaccard_join._pack(cells), n) == cells).all()
    edge = np.array([0, 0, (1 << 24) - 1], np.uint32)
    assert (jaccard_join._unpack(jaccard_join._pack(edge), 3) == edge).all()


def test_jaccard_common_counts():
    rng = np.random.default_rng(3)
    a, b = ([np.unique(rng.integers(0, 6000, rng.integers(0, 900))) for _ in range(12)] for _ in range(2))
    assert jaccard_join._common(a, b).tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]


def test_jaccard_block_links_join_components():
    import pyarrow as pa

    texts = ["a b c d e f g h i j", "a b c d e f g h i k", "z y x w v u t s r q", "a b c d e f g h i j"]
    t = pa.table({"node": [0, 1, 2, 3], "comp": [0, 1, 2, 3], "text": texts})
    # 5 of 7 shingles are shared: below 80, at or above 70 percent
    assert jaccard_join._join_components(t, t, 5, 80) == [(0, 3)]
    links = jaccard_join._join_components(t, t, 5, 70)
    assert {frozenset(x) for x in links} == {frozenset({0, 1}), frozenset({0, 3})}


def test_keep_one_rows_and_columns(spark, odd):
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] or -1) for r in kept.collect())
    assert ids == [-1, 1, 2, 3, 4, 6, 7, 8, 9, 10]


# -- mixing ----------------------------------------------------------------------------

def test_raking_meets_targets_both_ways(spark, docs):
    cells = mixing._keyed(docs).groupBy(
        F.col("__source").alias("source"), F.col("__lang").alias("lang"),
        F.col("__topic").alias("topic")).agg(F.sum("__tokens").alias("tokens"))
    goal = {"lang": {"en": 0.25, "de": 0.25, "fr": 0.25, "es": 0.25}}
    key = lambda r: (r["source"], r["lang"], r["topic"])
    small = {key(r): r["w"] for r in mixing.rake(cells, goal, small=True).collect()}
    large = {key(r): r["w"] for r in mixing.rake(cells, goal).collect()}
    assert small.keys() == large.keys()
    assert all(small[k] == pytest.approx(large[k], abs=1e-9) for k in small)
    total = sum(small.values())
    for lang in goal["lang"]:
        assert sum(w for k, w in small.items() if k[1] == lang) / total == pytest.approx(0.25, abs=0.02)


def test_mix_budget_and_edges(spark, docs, odd):
    m = mixing.mix(docs, budget=0.4)
    got = m.agg(F.sum(F.col("tokens") * F.col("prob")), F.sum("tokens"), F.max("prob")).first()
    assert got[0] / got[1] == pytest.approx(0.4, abs=1e-6) and got[2] <= 1
    again = mixing.mix(docs, budget=0.4)
    assert m.where("kept").select("doc_id").exceptAll(again.where("kept").select("doc_id")).isEmpty()
    o = mixing.mix(odd)
    assert o.count() == odd.count() and o.where("prob is null or weight is null").count() == 0
    assert mixing.mix(odd, budget=1.0).where("not kept").count() == 0
    assert mixing.mix(odd.limit(0)).count() == 0
    assert mixing.keep_mixed(odd).columns == odd.columns


# -- tokens ----------------------------------------------------------------------------

def test_bpe_equals_library_and_round_trips(spark, docs, odd):
    from tokenizers import Tokenizer

    path = _vocab()("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    extra = spark.createDataFrame([(-1, "<|endoftext|>a <|endoftext|> b"), (-2, " \t\n x  y \n"),
                                   (-3, "ab" * 5000), (-4, "it's we'LL 12３ \x1c\x85é")],
                                  "doc_id long, text string")
    for d in (docs.select("doc_id", "text"), odd.select("doc_id", "text"), extra):
        rows = sorted([(r["doc_id"] or 0, r["text"] or "") for r in d.collect()])
        got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                     for r in bpe.round_trip(d, path).collect())
        want = []
        for i, t in rows:
            ids = lib.encode(t, add_special_tokens=False).ids
            back = lib.decode(ids, skip_special_tokens=False)
            want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(back.encode()).hexdigest()))
        assert got == sorted(want)
    full = bpe.decode(bpe.encode(odd, path), path)
    assert full.where("decoded <> coalesce(text, '')").count() == 0
    assert full.columns == [*odd.columns, "ids", "n_tokens", "decoded"]
    assert bpe.encode(odd.limit(0), path).count() == 0


def test_bpe_speculation_needs_exact_merging_only_where_pairs_fail(docs):
    v = bpe.Vocabulary(_vocab()("byte_bpe_50k.json"))
    e = bpe.Encoder(v)
    e.batch([r["text"] for r in docs.collect()])
    assert 0 < e.exact < len(e.words)
    for w in list(e.words)[:300]:
        raw = w.encode()
        assert np.frombuffer(e.words[w], "<u4").tolist() == v.merge(raw) == v._merge_long(raw)
    assert v.decode(np.array([v.ids[b"\xc3"]])).decode() == "�"


def test_token_store_round_trip(spark, docs, odd):
    from tokenizers import Tokenizer

    path = _vocab()("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    for d, end in ((docs, 1), (odd, 1), (odd, None), (odd.limit(0), 1)):
        folder = scratch_path(spark, "store")
        token_store.write(d, folder, path, end_id=end, partitions=3)
        rows = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in d.collect()),
                      key=lambda r: (r[0], r[1] or ""))
        want, at = [], 0
        for i, t in rows:
            ids = lib.encode(t or "", add_special_tokens=False).ids + ([end] if end else [])
            want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        got = [(r["doc_id"] if r["doc_id"] is not None else -1, r["start"], r["n_tokens"], r["ids_crc32"])
               for r in token_store.read(spark, folder, digest=True).collect()]
        assert sorted(got, key=lambda x: x[1:]) == sorted(want, key=lambda x: x[1:])
        if d is docs:
            pick = [rows[3][0], rows[50][0]]
            found = token_store.lookup(spark, folder, pick)
            for i, t in rows:
                if i in pick:
                    assert found[i] == lib.encode(t, add_special_tokens=False).ids + [1]
            sha = spark.read.parquet(f"{folder}/segments").select("dict_sha256").distinct().collect()
            assert len(sha) == 1


def test_token_store_cuts_plain_pieces_as_the_tokenizer_does():
    path = _vocab()("word_bpe_49k.json")
    tok = token_store.CachedTokenizer(path)
    whole: list[bytes] = []
    encode = tok._encode
    tok._encode = lambda pieces: whole.extend(pieces) or encode(pieces)
    plain = [c for c in map(chr, range(0x21, 0x10000)) if not 0xd800 <= ord(c) < 0xe000
             and len("".join(token_store._CUT(c.lower()))) == len(c.lower())]
    assert len(plain) > 94 + 62 + 127 + 96
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(plain, rng.integers(1, 9))).replace("<|", "") for _ in range(4_000)]
    texts = [" ".join(plain), " ".join(f"ab{c}cd{c}{c}9" for c in plain).replace("<|", "<"), "\n".join(words),
             "it's WE'LL !'s ''s x''ve' 'tis d'd 1,234.56 $9.99%%% a--b... \"Straße\", ÇA-ET-LÀ l'été привет, Ёж!",
             "", None, " \n ", "K" + "ab" * 3_000]
    odd = ["<|startoftext|> a<|ENDOFTEXT|>b <|endoftext|>, h\u0331 H\u0331. A\u030angstro\u0308m! \u212bK \u017f\u0149\u0130i",
           "ΟΔΟΣ, ὈΔΥΣΣΕΎΣ. Ωmega\tx\u00a0y\x1cz\x85 中文，日本 “quoted” don’t x² ½ ªº µ ñandú\u00ad €5 😀"]
    want = [tok.lib.encode(t or "", add_special_tokens=False).ids for t in texts + odd]
    for _ in range(2):  # learned, then remembered
        got = tok.batch(pa.array([None, *texts, None], pa.string())[1:-1])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want[:len(texts)]
        assert whole == []  # only the model is needed, not the whole tokenizer
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in tok.batch(pa.array(odd))] == want[len(texts):]
        assert whole
        tok.older, tok.seen = tok.seen, {b"": b""}
    assert tok.batch(pa.array([None, None], pa.string())) == [b"", b""]
    assert tok.batch(pa.array([""])) == [b""]


def test_language_with_few_rows_keeps_its_words(spark):
    rng = np.random.default_rng(4)

    def text(letters, n):
        return " ".join("".join(rng.choice(list(letters), 4)) for _ in range(n))

    rows = [(i, text("abcdefgh", 200), "aa") for i in range(400)]
    small = [(1000 + i, text("щжюяэ", 10), "bb") for i in range(2)]
    d = spark.createDataFrame(rows + small, "doc_id long, text string, lang string")
    model = langid.fit(d, fit_rows=20, max_words=60, max_grams=60)
    assert model.langs == ("aa", "bb")
    assert all(w in model.words for _, t, _ in small for w in t.split())
    for r in langid.predict(d.where("lang = 'bb'"), model).collect():
        assert r["lang_pred"] == "bb" and r["score"] >= 0.3


# -- classifiers -----------------------------------------------------------------------

def test_toxic_words_are_restored():
    counts = toxicity.trigram_counts(np.frombuffer(
        (" the idiot was a moron and an idiot to the others in the street " * 50).encode(), np.uint8))
    tri = counts.reshape(28, 28, 28) + 0.01
    r = toxicity.Restorer(np.log(tri / tri.sum(2, keepdims=True)))
    assert "idiot" in r.words("an 1d10t")
    assert "idiot" in r.words("an i d i o t here")
    assert "idiot" in r.words("i.d.i.o.t")
    assert "idiot" in r.words("an idiooooot!!!")
    assert "idiot" in r.words("ID!OT***")
    assert r.words("street others") == {"street", "others"}
    assert r.words(None) == r.words("") == set()
    r.words("a " * 100_000 + "z" * 100_000)


def test_toxic_words_in_long_tokens_are_read():
    counts = toxicity.trigram_counts(np.frombuffer(
        (" the idiot was a moron and an idiot to the others in the street " * 50).encode(), np.uint8))
    tri = counts.reshape(28, 28, 28) + 0.01
    r = toxicity.Restorer(np.log(tri / tri.sum(2, keepdims=True)))
    for sign in "-_./,|":
        for fill in ("the", "街道的"):
            token = sign.join([fill] * 30 + ["idiot"] + [fill] * 40)
            assert "idiot" in r.words(token) and "idiot" in r.words(token * 4)
    assert "idiot" in r.words("the-1d10t-others")
    assert "moron" in r.words(".".join(["street"] * 30 + ["m0r0n"] + ["others"] * 30))


def _restorer():
    counts = toxicity.trigram_counts(np.frombuffer(
        (" the idiot was a moron and an idiot to the others in the street " * 50).encode(), np.uint8))
    tri = counts.reshape(28, 28, 28) + 0.01
    return toxicity.Restorer(np.log(tri / tri.sum(2, keepdims=True)))


def test_toxic_words_around_every_border_are_read(monkeypatch):
    r = _restorer()
    for n in range(380, 420):
        assert "idiot" in r.words("the-" * (n // 4) + "x" * (n % 4) + "-1d10t-others")
        assert "idiot" in r.words("t h e  " * (n // 7) + "s " * (n % 7) + " i d i o t  w a s")
    texts = ["the-" * 40 + "1d10t-m0r0n" * 9, "t h e  m o r o n  " * 12, "iddioott" * 30, "the.idi.ot" * 20]
    whole = [r.decode(t) for t in texts]
    for settle in (1, 2, 7, 64):
        monkeypatch.setattr(toxicity, "SETTLE", settle)
        assert [_restorer().decode(t) for t in texts] == whole


def test_toxic_words_with_doubled_letters_are_read():
    r = _restorer()
    assert {"iddiot", "idiot"} <= r.words("an iddiot")
    assert "street" in r.words("street") and "idiot" in r.words("idiott!")


def test_signs_cost_time_linear_in_their_number():
    r = _restorer()
    start = time.perf_counter()
    assert r.words("a" + "-" * 300_000 + "a") is not None
    assert r.words("-" * 500_000) == set() and "idiot" in r.words("*" * 200_000 + "idiot" + "!" * 200_000)
    assert time.perf_counter() - start < 20


def test_lattice_reading_is_the_best_of_all():
    """Every path through the lattice of short tokens, scored one by one."""
    r = _restorer()

    def arcs(token, at):
        ch = token[at]
        run = 1
        while at - run >= 0 and token[at - run] == ch:
            run += 1
        if "a" <= ch <= "z":
            yield ord(ch) - 96, toxicity._LETTER_BONUS
            if run > 1:
                yield -1, (toxicity._DROP_PAIR if run == 2 and ch * 3 not in token
                           else toxicity._DROP_REPEAT)
        elif ch in toxicity.LOOKALIKES:
            for x in toxicity.LOOKALIKES[ch]:
                yield ord(x) - 96, toxicity._LOOKALIKE + toxicity._LETTER_BONUS
            yield -1, toxicity._DROP_SIGN
            if not ch.isalnum():
                yield 0, toxicity._BREAK_SIGN
        elif ch == " ":
            yield -1, toxicity._SPACE / 2
            yield 0, toxicity._SPACE
        else:
            yield -1, toxicity._DROP_SIGN
            yield 0, toxicity._BREAK_SIGN

    def best(token):
        top = -1e18
        for path in itertools.product(*(list(arcs(token, i)) for i in range(len(token)))):
            x = y = 0
            total = 0.0
            for c, cost in path:
                if c == 0 and y == 0:
                    break
                total += cost
                if c >= 0:
                    total += r.lm[x][y][c]
                    x, y = (0, 0) if c == 0 else (y, c)
            else:
                total += r.lm[x][y][0] if y else 0.0
                if total > top:
                    top, text = total, "".join(" " if c == 0 else chr(96 + c) for c, _ in path if c >= 0)
        return text

    for token in ("1d10t", "m0r.0n", "i d i o t", "idd1ott", "!d!ot", "the-m0ron", "str33t", "ooottt", "a-1-b"):
        assert r.decode(token).strip() == best(token).strip(), token


def test_toxicity_finds_planted_words(spark, odd):
    rng = np.random.default_rng(1)
    words = [f"{a}{b}" for a in ("ba", "lo", "ti", "ren") for b in ("ma", "so", "nd", "el")]
    rows, labels = [], []
    for i in range(400):
        w = rng.choice(words, 30).tolist()
        toxic = int(i % 5 == 0)
        if toxic:
            w[7] = ["grobnak", "gr0bn4k", "g r o b n a k", "grobnaaaak"][i // 5 % 4]
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    logp = toxicity.character_model(d)
    model = toxicity.fit(d, lab.where("doc_id < 300"), logp)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(d, model).collect()}
    assert sum(got[i] == t for i, t in labels if i >= 300) >= 98
    out = toxicity.score(odd, model)
    assert out.count() == odd.count() and out.where("score is null").count() == 0
    none = toxicity.fit(d, lab.limit(0), logp)
    assert toxicity.score(odd, none).where("score <> 0").count() == 0
    empty = toxicity.character_model(d.limit(0))
    assert np.isfinite(empty).all()
    assert toxicity.score(d.limit(0), model).count() == 0


def test_quality_ranks_and_edges(spark, docs, odd):
    good = docs.select("doc_id", "text").where("text is not null").limit(100).collect()
    rows = [(i, r["text"]) for i, r in enumerate(good)]
    rows += [(1000 + i, " ".join(w + "###" for w in r["text"].split())) for i, r in enumerate(good)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows], "doc_id long, quality int")
    model = quality.fit(d, lab.where("doc_id % 4 <> 2"))
    got = {r["doc_id"]: r["predicted"] for r in quality.score(d, model).collect()}
    assert sum(got[i] == int(i < 1000) for i in got if i % 4 == 2) >= 48
    out = quality.score(odd, model)
    assert out.count() == odd.count() and out.where("score is null or predicted is null").count() == 0
    assert dict(out.dtypes)["score"] == "double"
    one = quality.fit(d, lab.where("quality = 0"))
    assert quality.score(odd, one).where("predicted <> 0").count() == 0
    none = quality.fit(d, lab.limit(0))
    assert quality.score(odd, none).where("predicted <> 1").count() == 0
    assert quality.score(odd.limit(0), model).count() == 0
