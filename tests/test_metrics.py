"""Ranking metrics against hand values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankbeam.operators import ranking as rk


def frame(spark, y, s, g):
    rows = [(int(gi), float(yi), float(si), i) for i, (yi, si, gi) in enumerate(zip(y, s, g))]
    return spark.createDataFrame(rows, "g long, y double, s double, eo long")


def metric(spark, name, y, s, g, k=None, hot=10**6, gain="exp"):
    df = frame(spark, y, s, g)
    out = rk.single_metric(df, name, ["g"], "y", "s", "eo", k=k, hot_rows=hot, gain=gain)
    return out.first()[0]


# Small rankings and their metrics.
@pytest.mark.parametrize("hot", [10**6, 2])
def test_hand_values(spark, hot):
    assert metric(spark, "ndcg", [3, 2, 1, 0], [.9, .7, .5, .1], [0] * 4, k=4, hot=hot) == pytest.approx(1.0)
    assert metric(spark, "mrr", [0, 1, 0, 1, 0], [.9, .8, .1, .9, .5], [0, 0, 0, 1, 1], k=5, hot=hot) == pytest.approx(0.75)
    assert metric(spark, "map", [1, 0, 1], [.9, .8, .7], [0, 0, 0], k=3, hot=hot) == pytest.approx(5 / 6)
    y, s, g = [1, 0, 1, 0, 0, 1], [.9, .8, .1, .9, .8, .1], [0, 0, 0, 1, 1, 1]
    assert metric(spark, "hitrate", y, s, g, k=2, hot=hot) == pytest.approx(0.5)
    assert metric(spark, "recall", y, s, g, k=2, hot=hot) == pytest.approx(0.25)
    assert metric(spark, "precision", y, s, g, k=2, hot=hot) == pytest.approx(0.25)
    assert metric(spark, "gauc", [1, 0, 0, 1], [.9, .1, .1, .9], [0, 0, 1, 1], hot=hot) == pytest.approx(1.0)
    assert metric(spark, "gauc", [1, 0, 0, 1], [.1, .9, .9, .1], [0, 0, 1, 1], hot=hot) == pytest.approx(0.0)


def test_group_without_positive_excluded(spark):
    y, s, g = [1, 0, 0, 0], [.9, .1, .5, .4], [0, 0, 1, 1]
    assert metric(spark, "mrr", y, s, g, k=2) == pytest.approx(1.0)
    assert metric(spark, "hitrate", y, s, g, k=2) == pytest.approx(1.0)


def _np_reference(y, s, g, k, thr=1.0):
    """Brute force per group in plain Python (stable sort, NaN last)."""
    out = {}
    groups = sorted(set(g))
    nd, ap, rr, hr, rc, pr, au = [], [], [], [], [], [], []
    for gg in groups:
        idx = [i for i in range(len(y)) if g[i] == gg]
        idx.sort(key=lambda i: (math.isnan(s[i]), -s[i] if not math.isnan(s[i]) else 0))
        rel = [y[i] for i in idx]
        ideal = sorted(rel, reverse=True)
        dcg = sum((2 ** r - 1) / math.log2(p + 2) for p, r in enumerate(rel[:k]))
        idcg = sum((2 ** r - 1) / math.log2(p + 2) for p, r in enumerate(ideal[:k]))
        if idcg > 0:
            nd.append(dcg / idcg)
        hits = [1 if r >= thr else 0 for r in rel]
        npos = sum(hits)
        if npos:
            c, a = 0, 0.0
            for p, h in enumerate(hits[:k]):
                c += h
                a += h * c / (p + 1)
            ap.append(a / min(npos, k))
            fh = [p for p, h in enumerate(hits[:k]) if h]
            rr.append(1 / (fh[0] + 1) if fh else 0.0)
            hk = sum(hits[:k])
            hr.append(1.0 if hk else 0.0)
            rc.append(hk / npos)
            pr.append(hk / k)
            n = len(hits)
            if npos < n:
                rs = sum((n - p) for p, h in enumerate(hits) if h)
                au.append((rs - npos * (npos + 1) / 2) / (npos * (n - npos)))
    mean = lambda v: float(np.mean(v)) if v else 0.0
    out.update({f"ndcg_at_{k}": mean(nd), f"map_at_{k}": mean(ap), f"mrr_at_{k}": mean(rr),
                f"hitrate_at_{k}": mean(hr), f"recall_at_{k}": mean(rc),
                f"precision_at_{k}": mean(pr), "gauc": mean(au), "n_groups": len(groups)})
    return out


@pytest.mark.parametrize("hot", [10**6, 100])
def test_all_metrics_brute_force(spark, hot):
    rng = np.random.default_rng(3)
    n = 600
    g = rng.choice([1, 2, 3, 4, 5, 6], n, p=[.5, .2, .1, .1, .05, .05]).tolist()  # one hot group
    y = rng.integers(0, 4, n).astype(float).tolist()
    s = rng.integers(0, 7, n).astype(float).tolist()  # many ties
    s[5] = float("nan")
    s[17] = float("nan")
    df = frame(spark, y, s, g)
    got = rk.ranking_metrics(df, ["g"], "y", "s", "eo", ks=(3, 10), hot_rows=hot).first().asDict()
    for k in (3, 10):
        exp = _np_reference(y, s, g, k)
        for name, v in exp.items():
            assert got[name] == pytest.approx(v, abs=1e-12), (name, k)


def test_rank_and_running_hits(spark):
    rng = np.random.default_rng(5)
    n = 300
    g = rng.choice([1, 2, 3], n, p=[.7, .2, .1]).tolist()
    y = rng.integers(0, 3, n).astype(float).tolist()
    s = rng.integers(0, 5, n).astype(float).tolist()
    df = frame(spark, y, s, g)
    out = rk.running_hits(df, ["g"], "y", "s", "eo", 1.0).select("g", "eo", "pos", "cum_hits").collect()
    got = {r["eo"]: (r["pos"], r["cum_hits"]) for r in out}
    assert len(got) == n
    for gg in set(g):
        idx = [i for i in range(n) if g[i] == gg]
        idx.sort(key=lambda i: (-s[i], i))
        c = 0
        for p, i in enumerate(idx):
            c += int(y[i] >= 1.0)
            assert got[i] == (p, c)


def test_hot_groups_cut_in_many_pieces(spark):
    """Pieces of a few rows: positions and hits carry over from one piece to the next."""
    rng = np.random.default_rng(9)
    n = 700
    g = rng.choice([1, 2, 3, 4], n, p=[.6, .2, .1, .1]).tolist()
    y = rng.integers(0, 4, n).astype(float).tolist()
    s = rng.integers(0, 6, n).astype(float).tolist()
    df = frame(spark, y, s, g)
    got = rk.ranking_metrics(df, ["g"], "y", "s", "eo", ks=(3, 10), hot_rows=20).first().asDict()
    rows = rk.running_hits(df, ["g"], "y", "s", "eo", 1.0, hot_rows=20).select("eo", "pos", "cum_hits").collect()
    for k in (3, 10):
        for name, v in _np_reference(y, s, g, k).items():
            assert got[name] == pytest.approx(v, abs=1e-12), (name, k)
    pos = {r["eo"]: (r["pos"], r["cum_hits"]) for r in rows}
    for gg in set(g):
        idx = sorted((i for i in range(n) if g[i] == gg), key=lambda i: (-s[i], i))
        c = 0
        for p, i in enumerate(idx):
            c += int(y[i] >= 1.0)
            assert pos[i] == (p, c)
