"""Ranker smoke test: metrics keys/ranges, importances, persistence."""

import itertools
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rankbeam.config import SPLIT
from rankbeam.operators.dataset import DatasetMeta
from rankbeam.operators import ranker as rkr
from rankbeam.operators import trees as tr
from rankbeam.plans import testdata as td
from rankbeam.session import scratch_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def fitted(spark):
    cfg = td.TD_CFG.with_model(max_iter=6, max_depth=4, metric_period=3, early_stop=False)
    st = td.Stage(spark, SF)
    d, meta = td.ds.assemble(st.inter, st.feats, st.bounds, cfg, st.vectors())
    d = d.cache()
    return cfg, d, meta, rkr.fit_and_evaluate(d, meta, cfg, curve=True)


def test_metrics_structure_and_ranges(fitted):
    cfg, _, _, res = fitted
    assert set(res.metrics) == {"val", "test"}
    for split, m in res.metrics.items():
        for k in cfg.eval.ks:
            for name in ("ndcg", "map", "mrr", "hitrate", "recall", "precision"):
                assert 0.0 <= m[f"{name}_at_{k}"] <= 1.0, (split, name, k)
        assert 0.0 <= m["gauc"] <= 1.0 and m["n_groups"] > 1


def test_predictions_not_constant(fitted):
    cfg, d, meta, res = fitted
    s = rkr.score(res.model, d.where(F.col(SPLIT) == "val"), meta, cfg)
    assert s.agg(F.stddev("prediction")).first()[0] > 1e-6


def test_importances_cover_all_features(fitted):
    _, _, meta, res = fitted
    rows = res.importances.collect()
    assert len(rows) == len(meta.num_features) + len(meta.cat_features)
    assert sum(abs(r["importance"]) for r in rows) > 0


def test_staged_curve_ends_at_model(fitted):
    _, _, _, res = fitted
    assert [r["iteration"] for r in res.curve] == [3, 6]
    assert res.curve[-1]["ndcg_at_10"] == pytest.approx(res.all_trees_metrics["val"]["ndcg_at_10"],
                                                        abs=1e-12)


def test_best_iteration_scoring(fitted):
    """Val/test are scored at the best validation iteration of the curve."""
    _, _, _, res = fitted
    best = max(res.curve, key=lambda r: r["ndcg_at_10"])
    assert res.best_iteration == best["iteration"]
    assert res.metrics["val"]["ndcg_at_10"] == pytest.approx(best["ndcg_at_10"], abs=1e-12)


def test_staged_score_at_all_trees_equals_predict(fitted):
    cfg, d, meta, res = fitted
    val = d.where(F.col(SPLIT) == "val")
    a = rkr.score(res.model, val, meta, cfg).select("event_order", F.col("prediction").alias("a"))
    b = rkr.staged_score(res.model, val, meta, cfg, 6).select("event_order", F.col("prediction").alias("b"))
    diff = a.join(b, "event_order").select(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]
    assert diff < 1e-9


def test_save_and_load(spark, fitted):
    cfg, d, meta, res = fitted
    path = scratch_path(spark, "model")
    rkr.save(res.model, path)
    back = rkr.load(path)
    val = d.where(F.col(SPLIT) == "val")
    a = rkr.score(res.model, val, meta, cfg).select("event_order", F.col("prediction").alias("a"))
    b = rkr.score(back, val, meta, cfg).select("event_order", F.col("prediction").alias("b"))
    assert a.join(b, "event_order").where(F.col("a") != F.col("b")).count() == 0


def test_ranker_beats_random_scores(fitted):
    from rankbeam.config import EVENT_ORDER, LABEL
    from rankbeam.operators import ranking as rk

    cfg, d, meta, res = fitted
    # One random order of 110 short lists is within 0.02 of any other: the mean of eight.
    val = d.where(F.col(SPLIT) == "val").withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(7))))
    val = val.withColumn("noise", F.xxhash64("event_order", "seed").cast("double"))
    noise = rk.ranking_metrics(val, [meta.group], LABEL, "noise", EVENT_ORDER, ks=(10,), by=["seed"])
    assert res.metrics["val"]["ndcg_at_10"] > noise.agg(F.avg("ndcg_at_10")).first()[0]


def test_early_stop_fits_with_the_val_split(fitted):
    cfg, d, meta, _ = fitted
    early = cfg.with_model(max_iter=12, step_size=0.9, early_stop=True, patience=3)
    model = rkr.fit(d, meta, early)
    assert 1 <= len(model.stages[-1].trees) <= 12
    with pytest.raises(ValueError):
        rkr.fit(d.where(F.col(SPLIT) == "train"), meta, early)
    with pytest.raises(ValueError):
        rkr.fit(d, meta, cfg.with_model(max_categories=1))


def test_flat_trees_equal_the_model(fitted):
    """Arrays of a printed ensemble, categorical splits included, give MLlib's predictions."""
    cfg, d, meta, res = fitted
    flat = tr.of_model(res.model.stages[-1])
    assert len(flat) == 6 and (flat.categories >= 0).any() and flat.weights[1:].tolist() == [0.1] * 5
    val = d.where(F.col(SPLIT) != "train")
    rows = rkr.score(res.model, val, meta, cfg).select(vector_to_array("features").alias("x"), "prediction").collect()
    x = np.array([r["x"] for r in rows])
    got = dict(flat.staged(x, [2, 6]))
    assert np.allclose(got[6], [r["prediction"] for r in rows], atol=1e-12)
    assert not np.allclose(got[2], got[6])


def test_curve_plan_does_not_grow_with_the_trees(spark, fitted):
    """2000 trees, a point every 25: one Python stage, the last point equals the prediction."""
    cfg, d, meta, res = fitted
    flat = tr.of_model(res.model.stages[-1])
    many = replace(flat, roots=np.resize(flat.roots, 2000), weights=np.full(2000, 1e-3))
    val = d.where((F.col(SPLIT) == "val") & (F.col("event_order") % 5 == 0))
    rows = rkr.feature_frame(val, meta.num_features, cfg)
    x = tr.with_array(PipelineModel(stages=res.model.stages[:-1]).transform(rows), "features")
    plans = []
    for trees, period in ((flat, 3), (many, 25)):
        out = rkr._stage_metrics(x, trees, meta, cfg.with_model(metric_period=period))
        plans.append(out._jdf.queryExecution().optimizedPlan().toString().count("\n"))
    assert plans[0] == plans[1]
    got = out.collect()
    assert sorted(r["iteration"] for r in got) == list(range(25, 2001, 25))


def test_gradients_equal_plain_pairs():
    rng = np.random.default_rng(0)
    owner, score = np.repeat([7, 3, 9], [5, 30, 1]), rng.standard_normal(36)
    label = rng.integers(0, 4, 36).astype(float)
    mix = rng.permutation(36)
    grad, curve = rkr.gradients(score[mix], label[mix], owner[mix], 4, rng)
    want = np.zeros((2, 36))
    for g in set(owner):
        rows = sorted(np.flatnonzero(owner == g), key=lambda i: -score[i])
        best = sorted((label[i] for i in rows), reverse=True)
        ideal = sum((2 ** y - 1) / np.log2(p + 2) for p, y in enumerate(best[:4]))
        for p, i in enumerate(rows):
            for q in range(p + 1, len(rows)):
                j = rows[q]
                if p >= 4 or label[i] == label[j]:
                    continue
                hi, lo = (i, j) if label[i] > label[j] else (j, i)
                w = abs(2 ** label[i] - 2 ** label[j]) * abs(1 / np.log2(p + 2) - 1 / np.log2(q + 2)) / ideal
                push = 1 / (1 + np.exp(score[hi] - score[lo]))
                want[0, hi] += push * w
                want[0, lo] -= push * w
                want[1, [i, j]] += push * (1 - push) * w
    assert np.allclose(grad, want[0][mix]) and np.allclose(curve, want[1][mix])


def test_lists_of_a_hot_user_are_cut(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("user_id"),
                                    F.col("id").alias("event_order"))
    got = rkr.lists(rows, "user_id", 100)
    per = got.groupBy("user_id").agg(F.count_distinct("_list").alias("n")).collect()
    assert {r["n"] for r in per if r["user_id"]} == {1} and max(r["n"] for r in per) == 10
    assert got.groupBy("_list").agg(F.count_distinct("user_id").alias("n")).where("n > 1").isEmpty()


def test_whole_lists_stay_together():
    ids = np.repeat([4, 4, 9, 1, 6], [3, 5, 1, 8, 2])
    for size in (1, 2, 3, 7, 19):
        batches = [pa.RecordBatch.from_arrays([pa.array(ids[i:i + size])], ["_list"]) for i in range(0, 19, size)]
        parts = [t.column("_list").to_pylist() for t in rkr._whole_lists(iter(batches), "_list")]
        assert sum(parts, []) == ids.tolist()
        assert all(a[-1] != b[0] for a, b in itertools.pairwise(parts))


def test_ranking_fit_is_better_than_the_pointwise_fit(spark, fitted):
    """Labels that differ more between users than within a list: squared error spends its
    splits on the users, pairs of one list on what orders it. Same seed, trees and depth."""
    cfg = fitted[0].with_model(max_iter=5, max_depth=2, metric_period=5, min_leaf_rows=1)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(2400):
        user, x, noise = i % 10, rng.random(), rng.random()
        label = float(np.clip(round(user / 10 * 4 + x + 0.2 * rng.standard_normal()), 0, 5))
        rows.append((user, i, i, label, user / 10, x, noise, ("train", "train", "val", "test")[i // 10 % 4]))
    d = spark.createDataFrame(rows, "user_id long, item_id long, event_order long, label double, bias double, "
                                    "x double, noise double, split string")
    meta = DatasetMeta("label", "user_id", "item_id", "event_order", ["bias", "x", "noise"], [])
    got = {loss: rkr.fit_and_evaluate(d, meta, cfg.with_model(loss=loss)).metrics["val"] for loss in rkr.LOSSES}
    assert got["lambdarank"]["ndcg_at_10"] > got["pointwise"]["ndcg_at_10"] + 0.02


def test_patience_ends_the_fit_at_the_best_iteration(fitted, monkeypatch):
    cfg, d, meta, _ = fitted
    values = iter([0.3, 0.5, 0.4, 0.45, 0.1, 0.9])
    fits = []
    real = rkr.DecisionTreeRegressor.fit
    monkeypatch.setattr(rkr.DecisionTreeRegressor, "fit", lambda self, x: fits.append(1) or real(self, x))

    class Val:
        def first(self):
            return {"ndcg_at_10": next(values)}

    monkeypatch.setattr(rkr.rk, "ranking_metrics", lambda *a, **k: Val())
    model = rkr.fit(d, meta, cfg.with_model(loss="lambdarank", max_iter=12, max_depth=2,
                                          metric_period=1, early_stop=True, patience=3))
    assert len(fits) == 5 and len(model.stages[-1].trees) == 2


def test_written_states_do_not_change_the_trees(fitted):
    cfg, d, meta, _ = fitted
    small = cfg.with_model(loss="lambdarank", max_iter=3, max_depth=3, list_rows=50)
    a, b = (rkr.fit(d, meta, small.with_model(trees_per_state=k)).stages[-1] for k in (50, 1))
    assert [t.toDebugString.split("\n")[1:] for t in a.trees][:1] == [t.toDebugString.split("\n")[1:] for t in b.trees][:1]
    assert len(a.trees) == len(b.trees) == 3


def test_best_metric_is_checked_before_the_fit(fitted):
    cfg, d, meta, _ = fitted
    assert rkr.best_metric(replace(cfg, eval=replace(cfg.eval, ks=(5, 20)))) == "ndcg_at_20"
    assert rkr.best_metric(cfg) == "ndcg_at_10"
    wrong = replace(cfg, eval=replace(cfg.eval, best_by="ndcg_at_7"))
    with pytest.raises(ValueError, match="best_by"):
        rkr.fit_and_evaluate(d, meta, wrong)
    with pytest.raises(ValueError, match="loss"):
        rkr.fit(d, meta, cfg.with_model(loss="other"))
