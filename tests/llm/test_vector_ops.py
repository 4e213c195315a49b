"""Vector operators against brute force, and their edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankbeam.llm import mtree, neardup
from rankbeam.llm.common import components


def _frame(spark, ids, x, labels):
    return spark.createDataFrame(
        [(int(i) if i is not None else None, None if v is None else [float(a) if a is not None else None
         for a in v], lab) for i, v, lab in zip(ids, x, labels, strict=True)],
        "vec_id long, embedding array<float>, label int")


def _plain_top(ids, x, k, ask):
    q = np.floor(256 * np.asarray(x, np.float32).astype(np.float64)).astype(np.int64)
    out = []
    for i in range(len(ids)):
        if not ask(ids[i]):
            continue
        s = q @ q[i]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out += [(ids[i], r + 1, ids[j], int(s[j])) for r, j in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("rows", [3, 900])
def test_top_k_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(mtree, "SHARD_ROWS", 128)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(rows)
    x = rng.standard_normal((rows, 12)).round(2) * rng.choice([0.1, 1.0, 3.0], (rows, 1))
    x[rows // 2:rows // 2 + rows // 3] = x[0]  # a third of all rows is one vector: ties
    ids = rng.permutation(rows * 2)[:rows]
    ids[0] = 100_000
    d = _frame(spark, ids, x, [0] * rows)
    got = sorted(tuple(r) for r in mtree.top_k(d, F.col("vec_id") % 10 == 0).collect())
    assert got == _plain_top(ids, x, 5, lambda i: i % 10 == 0)


def test_top_k_edges(spark):
    bad = _frame(spark, [0, 50, 100, 150, 7, None], [None, [1.0, None], [float("nan"), 1.0], [],
                                                    [1.0, 0.0], [0.5, 0.5]], [0] * 6)
    assert mtree.top_k(bad, F.col("vec_id") % 50 == 0).count() == 0
    assert mtree.top_k(bad.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = _frame(spark, [0, 1, 1], [[1.0, 0.0], [0.5, 0.5], [0.5, 0.5]], [0, 0, 0])
    got = [tuple(r) for r in mtree.top_k(few, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == [(0, 1, 1, 32768), (0, 2, 1, 32768)]


def test_top_k_rows_without_an_id_take_no_part(spark):
    big = 2 ** 53 + 1  # not a float64
    d = _frame(spark, [0, 7, big, None, 50, None], [[1.0, 0.0], [0.5, 0.5], [0.25, 0.0], [2.0, 2.0],
                                                    [0.0, 1.0], [1.0, 0.0]], [0] * 6)
    got = sorted(tuple(r) for r in mtree.top_k(d, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 7, 32768), (0, 2, big, 16384), (0, 3, 50, 0),
                   (50, 1, 7, 32768), (50, 2, 0, 0), (50, 3, big, 0)]


@pytest.mark.parametrize("scale", [1e6, 1e8, 1e12, 1e30])
def test_top_k_of_large_components_is_exact(spark, scale):
    rng = np.random.default_rng(4)
    x = [[scale * (i % 2 + 1), (2 * c + 1) / 256, 3.0] for i, c in enumerate(rng.integers(0, 9, 40).tolist())]
    d = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    q = [[int(np.floor(256 * a)) for a in v] for v in x]
    want = []
    for i in (0, 20):
        s = sorted((-min(sum(a * b for a, b in zip(q[i], q[j], strict=True)), 2 ** 63 - 1), j)
                   for j in range(40) if j != i)[:5]
        want += [(i, r + 1, j, -v) for r, (v, j) in enumerate(s)]
    got = mtree.top_k(d, F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_top_k_sends_pages_only_where_queries_reach(spark, monkeypatch):
    monkeypatch.setattr(mtree, "SHARD_ROWS", 32)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(6)
    spots = rng.standard_normal((8, 6)) * 50
    x = np.concatenate([s + rng.standard_normal((40, 6)) * 0.1 for s in spots]).round(3)
    ids = np.arange(320)
    got = mtree.top_k(_frame(spark, ids, x, [0] * 320), F.col("vec_id").between(0, 20))
    assert sorted(tuple(r) for r in got.collect()) == _plain_top(ids, x, 5, lambda i: i <= 20)


def test_pages_hold_their_rows_and_bounds():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((700, 9)) * 100
    pages = mtree.build_pages(np.arange(700), x, x[0])
    assert sorted(np.concatenate([p["ids"] for p in pages]).tolist()) == list(range(700))
    for p in pages:
        d = np.sqrt(((p["rows"] - p["centre"]) ** 2).sum(1))
        assert len(p["ids"]) <= mtree.PAGE and d.max() <= p["radius"] + 1e-3
        assert np.allclose(d, p["dist"], atol=1e-3)


def _plain_links(ids, x, labels, t=0.93):
    n = len(ids)
    x = np.asarray(x, np.float32).astype(np.float64)
    u = x / np.sqrt((x * x).sum(1))[:, None]
    same = np.asarray(labels)[:, None] == np.asarray(labels)[None, :]
    hit = (u @ u.T >= t) & same & ~np.eye(n, dtype=bool)
    comp = np.arange(n)
    for _ in range(n):
        new = np.array([min([comp[i], *comp[hit[i]]]) for i in range(n)])
        if (new == comp).all():
            break
        comp = new
    low = {c: min(ids[i] for i in range(n) if comp[i] == c) for c in set(comp.tolist())}
    return {ids[i]: (int(hit[i].sum()), low[comp[i]]) for i in range(n)}


def test_near_dedup_equals_brute_force(spark, monkeypatch):
    """Groups below and above the list length, over several blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 64)
    rng = np.random.default_rng(3)
    x, labels = [], []
    for g, size in enumerate([1] * 150 + [3] * 30 + [12] * 6 + [150]):
        centre = rng.standard_normal(24)
        for _ in range(size):
            x.append((centre + rng.standard_normal(24) * (0.0 if g % 7 == 3 else 0.12)).round(3))
            labels.append(g % 2)
    ids = rng.permutation(len(x) * 3)[:len(x)].tolist()
    want = _plain_links(ids, x, labels)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in neardup.link(_frame(spark, ids, x, labels)).collect()}
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][0] for i in want) >= 0.95 * sum(n for n, _ in want.values())
    assert np.mean([got[i][1] == want[i][1] for i in want]) >= 0.95
    assert all(k == (i == c) for i, (_, c, k) in got.items())


def _without_edges(make, keep=None):
    """``make`` as a search that finds only the edges under ``keep``, or none."""
    return lambda *a: make(*a).where(F.lit(False) if keep is None else keep)


def test_near_dedup_is_exact_where_the_search_fails(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK", 64)
    monkeypatch.setattr(neardup, "EXTRA", 1)
    monkeypatch.setattr(neardup, "_table", _without_edges(neardup._table))
    rng = np.random.default_rng(5)
    x, labels = [], []
    for g, size in enumerate([1] * 20 + [2] * 40 + [30] * 2):
        centre = rng.standard_normal(16)
        for _ in range(size):
            x.append((centre + rng.standard_normal(16) * (0.0 if g % 7 == 3 else 0.12)).round(3))
            labels.append(g % 2)
    ids = rng.permutation(len(x) * 3)[:len(x)].tolist()
    got = {r["vec_id"]: (r["n_links"], r["component_id"])
           for r in neardup.link(_frame(spark, ids, x, labels)).collect()}
    assert got == _plain_links(ids, x, labels)


def test_near_dedup_dense_group_hides_no_lost_pairs(spark, monkeypatch):
    """A third of the classes is one dense group; the search loses the isolated pairs."""
    for name in ("_table", "_descend"):
        monkeypatch.setattr(neardup, name, _without_edges(getattr(neardup, name), F.col("cos") >= 0.975))
    monkeypatch.setattr(neardup, "SPARSE", 8, raising=False)
    rng = np.random.default_rng(6)
    unit = rng.standard_normal((1300, 32))
    unit /= np.sqrt((unit * unit).sum(1))[:, None]
    x = [unit[0] + 0.01 * v for v in unit[:400]]
    for a, b in zip(unit[400:700], unit[700:1000], strict=True):
        b = b - (a @ b) * a
        x += [a, 0.95 * a + np.sqrt(1 - 0.95 ** 2) * b / np.sqrt(b @ b)]
    x += list(unit[1000:])
    ids = rng.permutation(len(x)).tolist()
    got = {r["vec_id"]: (r["n_links"], r["component_id"])
           for r in neardup.link(_frame(spark, ids, x, [0] * len(x))).collect()}
    assert got == _plain_links(ids, x, [0] * len(x))


def test_near_dedup_search_meets_the_goal_itself(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 64)
    monkeypatch.setattr(neardup, "SPARSE", 8)
    monkeypatch.setattr(neardup, "_exact", None)  # not needed
    rng = np.random.default_rng(7)
    x = [c + 0.12 * v for size in [1] * 150 + [3] * 60 + [12] * 10 + [150]
         for c in [rng.standard_normal(24)] for v in rng.standard_normal((size, 24))]
    ids = rng.permutation(len(x)).tolist()
    want = _plain_links(ids, x, [0] * len(x))
    got = {r["vec_id"]: r["n_links"] for r in neardup.link(_frame(spark, ids, x, [0] * len(x))).collect()}
    both = [got[i] / n for i, (n, _) in want.items() if n]
    assert all(got[i] <= n for i, (n, _) in want.items()) and np.mean(both) >= neardup.GOAL


def test_near_dedup_tables_grow_with_the_bits():
    chance = 1 - np.arccos(0.93) / np.pi
    for n in (10 ** 3, 10 ** 5, 10 ** 7, 10 ** 8):
        bits = neardup._bits(n)
        assert 1 - (1 - chance ** bits) ** neardup._tables(bits, 0.93) >= neardup.GOAL


def test_near_dedup_edges(spark):
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [float("inf"), 1.0], 0),
            (6, [1.0, 1.0], None), (7, [1.0, 1.0], 1), (8, [1.0, 1.0], 1), (9, [2.0, 2.0], 1),
            (9, [2.0, 2.0], 1), (10, [1.0, 1.0], 2)]
    d = _frame(spark, [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])
    got = sorted(tuple(r) for r in neardup.link(d.withColumn("node", F.lit(1))).collect())
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10)]
    assert got == sorted(alone + [(7, 3, 7, True), (8, 3, 7, False), (9, 3, 7, False), (9, 3, 7, False)])
    assert neardup.link(d.limit(0)).count() == 0
    assert neardup.link(d.where("vec_id < 4")).count() == 3


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + \
            [(200, 200), (None, 3), (301, 300), (300, 301), (300, 301)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_dedup_searches_small_tables_too(spark, monkeypatch):
    """The given table: tables and neighbour rounds make the result, not the exact comparison."""
    calls = {"table": 0, "descend": 0}
    table, descend = neardup._table, neardup._descend

    def counted(name, real):
        def fn(*args):
            calls[name] += 1
            return real(*args)
        return fn

    monkeypatch.setattr(neardup, "_table", counted("table", table))
    monkeypatch.setattr(neardup, "_descend", counted("descend", descend))
    monkeypatch.setattr(neardup, "_exact", lambda *a: pytest.fail("compared all classes"))
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert neardup.link(vectors).count() == vectors.count()
    assert calls["table"] >= neardup.TABLES and calls["descend"] >= 1
