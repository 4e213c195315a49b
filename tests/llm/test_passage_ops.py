"""Substring dedup, periodic runs and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankbeam.llm import periodic_runs, resampling, substring_dedup
from rankbeam.llm.shingles import word_hashes

WORD = "[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, very long, repeated rows and ids, columns with clashing names."""
    same = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \n\t\x0b "), (4, same), (4, same), (5, same.upper()), (6, same + " tail"),
            (None, same), (7, "x" * 300_000), (8, "é😀 ٣ " * 20_000), (None, None), (9, "A a " * 30), (-3, same[:60])]
    return spark.createDataFrame([(i, t, 1, "b", "k") for i, t in rows],
                                 SCHEMA + ", block int, kept string, score string")


# -- substring dedup ---------------------------------------------------------------

def plain_repeats(rows, width=13):
    words = [(i, re.findall(WORD, t or "")) for i, t in rows]
    lowest = {}
    for i, w in words:
        for s in range(len(w) - width + 1):
            k = tuple(w[s:s + width])
            if i is not None:
                lowest[k] = min(i, lowest.get(k, i))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - width + 1):
            if i is not None and lowest[tuple(w[s:s + width])] < i:
                gone.update(range(s, s + width))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), _sha(" ".join(kept))))
    return out


def _key(row):
    return tuple((v is None, v) for v in row)


def _same(got, want):
    assert sorted(map(tuple, got), key=_key) == sorted(want, key=_key)


def test_repeats_equal_brute_force_at_every_shift(spark):
    rng = random.Random(7)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for i in range(120):
        before = [f"u{rng.randrange(10**6)}" for _ in range(i % 29)]
        n = rng.choice([12, 13, 14, 19, 20, 60])
        s = rng.randrange(60 - n + 1)
        rows.append((rng.randrange(10**9), " ".join(before + passage[s:s + n] + [f"v{i}"])))
    rows += [(10**10 + k, " ".join(rng.choice("ab") for _ in range(300))) for k in range(4)]
    got = substring_dedup.digest(substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA))).collect()
    _same(got, plain_repeats(rows))


def test_repeats_of_odd_rows_and_their_spans(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = substring_dedup.remove_repeats(odd)
    _same(substring_dedup.digest(found).collect(), plain_repeats(rows))
    for r in found.collect():
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
    six = found.where("doc_id = 6").first()
    assert [tuple(s) for s in six["removed"]] == [(0, 40)] and six["kept"] == "tail"


def test_repeats_across_blocks_and_buckets(spark, monkeypatch):
    """A third of all rows shares one passage; blocks and buckets of a few kilobytes."""
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 500)
    shared = " ".join(f"s{k}" for k in range(20))
    rows = [(k, f"n{k} " * (k % 9) + (shared if k % 3 == 0 else f"q{k} " * 20) + f" z{k}") for k in range(600)]
    got = substring_dedup.digest(substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA))).collect()
    _same(got, plain_repeats(rows))


def test_every_shift_has_a_shared_anchor():
    for shift in range(substring_dedup.PERIOD):
        assert any((c + shift) % substring_dedup.PERIOD in substring_dedup.COVER for c in substring_dedup.COVER)


def test_repeats_of_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.remove_repeats(none).collect() == []
    assert periodic_runs.digest(periodic_runs.find(none)).collect() == []
    with pytest.raises(ValueError, match="width"):
        substring_dedup.remove_repeats(none, width=8)


# -- periodic runs -----------------------------------------------------------------

def plain_runs(w, least=24, periods=3):
    found = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, periods * q):
                found.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _runs_of(texts, **kw):
    """Runs by the operator's array code, all texts together."""
    data = [" ".join(t).encode() for t in texts]
    off = np.cumsum([0, *map(len, data)])
    h, doc = word_hashes(np.frombuffer(b"".join(data), np.uint8), off, fold=False)
    counts = np.bincount(doc, minlength=len(texts))
    ends = np.cumsum(counts)
    start, length, period = periodic_runs.find_runs(h, doc, ends[doc] - np.arange(len(doc)), **kw)
    out = [[] for _ in texts]
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True):
        out[doc[s]].append((s - int((ends - counts)[doc[s]]), n, q))
    return out


def _texts(rng):
    """Random words of few kinds, powers of blocks, powers of powers, broken in places."""
    out = []
    for _ in range(6):
        w = []
        while len(w) < rng.choice([10, 80, 300]):
            block = [rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 13, 16, 17, 31]))]
            if rng.random() < 0.4:
                block = block * rng.randrange(2, 9) + [rng.choice("abcd")]
            w += block * rng.choice([1, 1, 3, 4, 6])
            if rng.random() < 0.5:
                w += [rng.choice("xyz") for _ in range(rng.randrange(4))]
        out.append(w)
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**9))
def test_runs_equal_brute_force(seed):
    texts = _texts(random.Random(seed))
    assert _runs_of(texts) == [plain_runs(w) for w in texts]


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from([(2, 3), (5, 3), (6, 4), (50, 3)]))
def test_runs_of_other_lengths(seed, kind):
    least, periods = kind
    texts = _texts(random.Random(seed))
    got = _runs_of(texts, min_length=least, min_periods=periods)
    assert got == [plain_runs(w, least, periods) for w in texts]


def test_wavelet_tree_counts_and_selects():
    rng = np.random.default_rng(3)
    values = rng.permutation(200)
    tree = periodic_runs.WaveletTree(values)
    lo = rng.integers(0, 200, 500)
    hi = np.minimum(200, lo + rng.integers(1, 90, 500))
    x = rng.integers(0, 300, 500)
    assert tree.below(lo, hi, x).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(lo, hi, x, strict=True)]
    k = (rng.random(500) * (hi - lo)).astype(int)
    assert tree.kth(lo, hi, k).tolist() == [int(np.sort(values[a:b])[c]) for a, b, c in zip(lo, hi, k, strict=True)]


def plain_tail(i, w):
    h = zlib.crc32(str(i).encode())
    if i is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]


def plain_digest(i, text):
    w = plain_tail(i, re.findall(WORD, text or ""))
    runs = plain_runs(w)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-math.inf if False else -r[1] / r[2], r[0], r[2]), default=None)
    return (i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            _sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            _sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_run_digests_equal_brute_force(spark, odd):
    rng = random.Random(5)
    rows = [(k - 20, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 30, 90, 400])))) for k in range(200)]
    rows += [(1000 + k, " ".join(w)) for k, w in enumerate(_texts(rng))]
    rows += [(r["doc_id"], r["text"]) for r in odd.where("doc_id is null or doc_id < 8").collect()]
    d = spark.createDataFrame(rows, SCHEMA)
    tailed = d.select("doc_id", periodic_runs.repeat_tail(F.col("text"), F.col("doc_id")).alias("text"))
    _same(periodic_runs.digest(periodic_runs.find(tailed)).collect(), [plain_digest(i, t) for i, t in rows])


def test_runs_of_very_long_repetition_and_odd_rows(spark, odd):
    found = {r["doc_id"]: r for r in periodic_runs.find(odd).where("doc_id is not null").collect()}
    assert [tuple(r) for r in found[8]["runs"]] == [(0, 40_000, 2)] and found[8]["collapsed"] == "é😀 ٣"
    assert found[1]["n_words"] == 0 and found[1]["runs"] == [] and found[1]["collapsed"] == ""
    assert [tuple(r) for r in found[9]["runs"]] == [(0, 60, 2)]


# -- importance resampling ---------------------------------------------------------

def _words(text):
    table = {c: c + 32 for c in range(65, 91)}
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(table))


def plain_resample(rows, target, percent=10, least=20, buckets=10_000, max_n=1):
    def found(text):
        w = _words(text)
        return [zlib.crc32(" ".join(w[k:k + n]).encode()) % buckets
                for n in range(1, max_n + 1) for k in range(len(w) - n + 1)]
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(found(x))
    for x in target:
        t.update(found(x))
    S, T = sum(s.values()), sum(t.values())
    out, able = [], []
    for i, x in rows:
        f = found(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in f)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(_words(x)) >= least:
                able.append((-score, i, len(out)))
        out.append([i, len(f), weight, score, None])
    for r, (_, _, k) in enumerate(sorted(able)[:percent * len(able) // 100]):
        out[k][4] = r + 1
    return [tuple(r) for r in out]


def _docs(seed, n):
    rng = random.Random(seed)
    return [(k * 3 - 50, " ".join(f"W{rng.randrange(200)}" for _ in range(rng.choice([0, 5, 19, 20, 60]))))
            for k in range(n)]


@pytest.mark.parametrize("max_n", [1, 2])
def test_resampling_equals_brute_force(spark, max_n):
    rows, target = _docs(1, 500), [t for _, t in _docs(2, 40)] + [None, ""]
    got = resampling.resample(spark.createDataFrame(rows, SCHEMA),
                              spark.createDataFrame([(t,) for t in target], "text string"), max_n=max_n)
    _same(got.drop("n_words").collect(), plain_resample(rows, target, max_n=max_n))


def test_resampling_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = resampling.resample(odd, odd.limit(0), percent=50).drop("n_words").collect()
    want = plain_resample(rows, [], percent=50)
    # The two equal rows of id 4 may change places.
    _same(got, want)
    assert resampling.resample(odd.limit(0), odd).collect() == []


@pytest.mark.parametrize("kind", ["spread", "one score", "few scores", "one row many times"])
def test_cutoff_equals_sorting(spark, kind, monkeypatch):
    monkeypatch.setattr(resampling, "SORTED_ROWS", 50)
    rng = np.random.default_rng(4)
    n = 4000
    score = {"spread": rng.integers(-10**6, 10**6, n), "one score": np.full(n, 7), "few scores": rng.choice([1, 2, 9], n),
             "one row many times": np.full(n, 3)}[kind]
    ids = np.full(n, 5) if kind == "one row many times" else rng.permutation(n) - 100
    d = spark.createDataFrame(list(zip(ids.tolist(), score.tolist(), strict=True)), "doc_id long, score long")
    order = np.lexsort((ids, -score))
    for k in (1, 399, 2000, n):
        cut = resampling.find_cutoff(d, k)
        assert (cut.score, cut.doc_id) == (score[order[k - 1]], ids[order[k - 1]])
    assert resampling.find_cutoff(d, 0) is None


def test_bracket_widens_when_the_sketch_misses(spark, monkeypatch):
    d = spark.range(1000).select(F.col("id").alias("doc_id"), F.col("id").alias("score"))
    calls = defaultdict(int)
    real = F.percentile_approx

    def off(col, wanted, accuracy):
        calls["n"] += 1
        return real(col, [0.1, 0.2] if calls["n"] == 1 else wanted, accuracy)

    monkeypatch.setattr(resampling.F, "percentile_approx", off)
    low, high, above = resampling._bracket(d, F.col("score"), 100, 1000)
    assert calls["n"] > 1 and low <= 900 <= high and above == 999 - high
