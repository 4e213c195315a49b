"""Features: bounds, train-window aggregates (recomputed), cosine, id lookup."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankbeam.config import EVENT_ORDER, LABEL, WATCH_RATIO
from rankbeam.operators import checks
from rankbeam.operators import features as ft
from rankbeam.operators import vectors as vx
from rankbeam.operators.quantile import exact_quantiles, nearest_rank
from rankbeam.session import scratch_path
from rankbeam.plans import testdata as td

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stage(spark):
    return td.Stage(spark, SF)


def test_fixture_expectations(stage):
    """Numbers fixed in FIXTURES.md for the sf0.01 tables."""
    assert stage.inter.count() == 5166
    assert (stage.bounds.train_end, stage.bounds.val_end) == (7997, 8985)
    sizes = {r["split"]: r["n_rows"] for r in ft.split_sizes(stage.split()).collect()}
    assert sizes == {"train": 4132, "val": 517, "test": 517}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 999, 5000])
def test_exact_quantiles_random(spark, n):
    rng = np.random.default_rng(n)
    vals = np.sort(rng.choice(10 * n + 5, n, replace=False))
    df = spark.createDataFrame([(int(v),) for v in rng.permutation(vals)], "v long")
    qs = [0.0, 0.1, 0.5, 0.8, 0.8 + 0.1, 1.0]
    got = exact_quantiles(df, "v", qs, fanout=16)
    assert got == [int(vals[nearest_rank(n, q)]) for q in qs]


def test_nearest_rank_published_sizes():
    n = 47_976_280
    assert nearest_rank(n, 0.8) == 38_381_023
    assert nearest_rank(n, 0.8 + 0.1) - nearest_rank(n, 0.8) == 4_797_628


def test_aggregates_equal_recomputation(stage):
    train = ft.train_window(stage.inter, stage.bounds).toPandas()
    assert train[EVENT_ORDER].max() < stage.bounds.train_end
    uf = stage.feats.user.toPandas().set_index("user_id").sort_index()
    g = train.groupby("user_id")
    assert (uf["user_n_events"].to_numpy() == g.size().sort_index().to_numpy()).all()
    assert np.allclose(uf["user_mean_watch_ratio"], g["watch_ratio"].mean().astype(float).sort_index())
    assert (uf["user_n_authors"].to_numpy() == g["author_id"].nunique().sort_index().to_numpy()).all()
    assert np.allclose(uf["user_like_rate"], g["like"].mean().sort_index())
    itf = stage.feats.item.toPandas().set_index("item_id").sort_index()
    assert np.allclose(itf["item_mean_label"], train.groupby("item_id")["label"].mean().sort_index())
    ua = stage.feats.ua.toPandas().set_index(["user_id", "author_id"]).sort_index()
    assert (ua["ua_n_events"].to_numpy()
            == train.groupby(["user_id", "author_id"]).size().sort_index().to_numpy()).all()


def test_item_set_is_train_window(stage):
    train = ft.train_window(stage.inter, stage.bounds)
    assert checks.item_set_mismatch(stage.feats.item, train, stage.cfg) == 0


def test_distinct_counts_null_as_value(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (1, 5), (2, None)], "user_id long, author_id long")
    out = {r[0]: r[1] for r in df.groupBy("user_id").agg(ft.n_unique("author_id")).collect()}
    assert out == {1: 2, 2: 1}


def test_cosine_one_per_event_in_range(stage):
    some = stage.unit().where(F.col("item_id") % 5 != 0)  # the others have no vector
    cos = vx.attach_cosine(stage.inter.select(EVENT_ORDER, "user_id", "item_id"), stage.profiles(),
                           some, stage.cfg, stage.dim())
    assert cos.count() == stage.inter.count()
    assert cos.select(EVENT_ORDER).distinct().count() == cos.count()
    assert checks.cosine_out_of_range(cos).count() == 0
    assert cos.where(F.isnan("emb_cos")).count() > 0  # items without a vector


def test_profiles_unit_norm_and_zero_profile(spark, stage):
    norms = [math.sqrt(sum(x * x for x in r["profile"])) for r in stage.profiles().collect()]
    assert all(abs(n - 1) < 1e-9 for n in norms)
    # vectors that cancel: the profile exists and the cosine is 0
    vec = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0])], "item_id long, vec array<double>")
    inter = spark.createDataFrame([(0, 7, 1, 2.0), (1, 7, 2, 2.0)],
                                  "event_order long, user_id long, item_id long, label float")
    prof = vx.user_profiles(inter, vec, 10, stage.cfg, 2)
    row = prof.first()
    assert row["n_votes"] == 2 and row["profile"] == [0.0, 0.0]
    cos = vx.attach_cosine(inter, prof, vec, stage.cfg, 2).collect()
    assert all(r["emb_cos"] == 0.0 for r in cos)


def test_id_lookup_hand_values(spark):
    ids = spark.createDataFrame([(10,), (20,), (30,), (40,)], "item_id long")
    q = spark.createDataFrame([(30,), (10,), (99,), (40,), (5,)], "item_id long")
    got = {r["item_id"]: r["idx"] for r in vx.id_lookup(ids, q, "item_id").collect()}
    assert got == {30: 2, 10: 0, 99: -1, 40: 3, 5: -1}


def test_narrow_vectors_with_wide_truncation(spark, stage):
    """Stored vectors narrower than embedding_dim (8 < 32) still give a cosine."""
    vec = spark.createDataFrame([(1, [3.0, 4.0] + [0.0] * 6), (2, [0.0, 1.0] + [0.0] * 6)],
                                "item_id long, embedding array<float>")
    inter = spark.createDataFrame([(0, 7, 1, 2.0), (1, 7, 2, 0.0), (2, 7, 2, 0.0)],
                                  "event_order long, user_id long, item_id long, label float")
    dim = vx.vector_width(vec, stage.cfg)
    assert dim == 8
    unit = vx.unit_vectors(vec, stage.cfg)
    prof = vx.user_profiles(inter, unit, 10, stage.cfg, dim)
    got = {r["event_order"]: r["emb_cos"] for r in vx.attach_cosine(inter, prof, unit, stage.cfg, dim).collect()}
    assert got[0] == pytest.approx(1.0) and got[1] == pytest.approx(0.8)


def test_stored_cosine_roundtrip(spark, stage):
    """S13 sink + J5 join give the same column as the fused computation."""
    from rankbeam.plans import sinks
    from rankbeam.session import scratch_path

    base = stage.inter.select(EVENT_ORDER, "user_id", "item_id")
    fused = vx.attach_cosine(base, stage.profiles(), stage.unit(), stage.cfg, stage.dim())
    path = sinks.write_cosine(fused, scratch_path(spark, "cos"))
    joined = vx.attach_stored_cosine(base, spark.read.parquet(path))
    a = {r[EVENT_ORDER]: r["emb_cos"] for r in fused.collect()}
    b = {r[EVENT_ORDER]: r["emb_cos"] for r in joined.collect()}
    assert a.keys() == b.keys()
    assert all((math.isnan(a[k]) and math.isnan(b[k])) or a[k] == b[k] for k in a)
    assert vx.attach_stored_cosine(base, None) is base


def _avg(col):
    return F.avg(F.col(col).cast("double"))


def direct_user(train, cfg):
    """A4."""
    c = cfg.columns
    return train.groupBy(c.user_id).agg(
        F.count(F.lit(1)).alias("user_n_events"),
        _avg(WATCH_RATIO).alias("user_mean_watch_ratio"),
        _avg(c.timespent).alias("user_mean_timespent"),
        _avg(c.duration).alias("user_mean_duration"),
        ft.n_unique(c.author_id).alias("user_n_authors"),
        *ft.rate_cols(c.feedback, "user"),
    )


def direct_item(train, cfg):
    """A5."""
    c = cfg.columns
    return train.groupBy(c.item_id).agg(
        F.count(F.lit(1)).alias("item_n_views"),
        _avg(WATCH_RATIO).alias("item_mean_watch_ratio"),
        _avg(LABEL).alias("item_mean_label"),
        *ft.rate_cols(c.feedback, "item"),
    )


def direct_author(train, cfg):
    """A6 (a null author forms its own group, which never joins back)."""
    c = cfg.columns
    return train.groupBy(c.author_id).agg(
        F.count(F.lit(1)).alias("author_n_views"),
        ft.n_unique(c.item_id).alias("author_n_items"),
        _avg(WATCH_RATIO).alias("author_mean_watch_ratio"),
        *ft.rate_cols(c.feedback, "author"),
    )


def direct_user_author(train, cfg):
    """A7."""
    c = cfg.columns
    return train.groupBy(c.user_id, c.author_id).agg(
        F.count(F.lit(1)).alias("ua_n_events"),
        _avg(WATCH_RATIO).alias("ua_mean_watch_ratio"),
        _avg(LABEL).alias("ua_mean_label"),
    )


def test_rolled_up_aggregates_equal_direct(spark, stage):
    """build_aggregates (two scans, rolled up) equals the direct group-bys."""
    train = ft.train_window(stage.inter, stage.bounds)
    direct = {"user": direct_user(train, stage.cfg), "item": direct_item(train, stage.cfg),
              "author": direct_author(train, stage.cfg),
              "ua": direct_user_author(train, stage.cfg)}
    keys = {"user": ["user_id"], "item": ["item_id"], "author": ["author_id"],
            "ua": ["user_id", "author_id"]}
    for name, d in direct.items():
        r = getattr(stage.feats, name)
        assert sorted(r.columns) == sorted(d.columns)
        a = {tuple(x[k] for k in keys[name]): x.asDict() for x in d.collect()}
        b = {tuple(x[k] for k in keys[name]): x.asDict() for x in r.collect()}
        assert a.keys() == b.keys()
        for k in a:
            for col, v in a[k].items():
                if isinstance(v, (int, float)):
                    assert b[k][col] == pytest.approx(v, rel=1e-12, abs=1e-12), (name, col)
                else:
                    assert b[k][col] == v


def test_id_lookup_many_partitions(spark):
    """One group spanning many range partitions: index equals the ascending rank."""
    rng = np.random.default_rng(11)
    ids = np.unique(rng.integers(0, 10**9, 3000))
    q = np.concatenate([ids[::7], rng.integers(0, 10**9, 200)])
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        idf = spark.createDataFrame([(int(x),) for x in rng.permutation(ids)], "item_id long")
        qdf = spark.createDataFrame([(int(x),) for x in np.unique(q)], "item_id long")
        got = {r["item_id"]: r["idx"] for r in vx.id_lookup(idf, qdf, "item_id").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    pos = {int(x): i for i, x in enumerate(ids)}
    assert got == {int(x): pos.get(int(x), -1) for x in np.unique(q)}


def test_no_vector_for_any_item(spark, stage):
    """Vectors exist but none for the log's items: emb_cos is NaN everywhere."""
    from rankbeam.operators import dataset as ds

    vec = spark.createDataFrame([(10**9, [1.0, 2.0])], "item_id long, embedding array<float>")
    d, meta = ds.assemble(stage.inter, stage.feats, stage.bounds, stage.cfg, vec)
    assert "emb_cos" in meta.num_features
    assert d.where(~F.isnan("emb_cos")).count() == 0


def test_quantile_round_is_one_scan(spark):
    """All targets of a round, their ranges equal or apart, share one scan."""
    from rankbeam.operators.quantile import exact_ranks, histogram

    path = scratch_path(spark, "ranks")
    spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).write.parquet(path)
    x = spark.read.parquet(path)
    plan = histogram(x, [(0, 99), (500, 600), (900, 999)], 8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan
    assert exact_ranks(x, "v", [0, 1, 499, 998, 999], fanout=5) == [0, 1, 499, 998, 999]
