"""The whole job from a raw folder: stages, sinks, reports, reload."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rankbeam.config import SPLIT
from rankbeam.operators import dataset as ds
from rankbeam.operators import ranker as rkr
from rankbeam.plans import job
from rankbeam.plans import testdata as td
from rankbeam.session import scratch_path
from rankbeam.sources import shard_tree

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    raw = shard_tree.cached_tree(spark, SF)
    out = scratch_path(spark, "job")
    cfg = td.SMOKE_CFG.with_model(loss="pointwise", max_iter=3, max_depth=3, early_stop=False)
    return cfg, out, job.run(spark, raw, out, cfg)


def test_stats_and_sizes(spark, run):
    cfg, out, res = run
    inter = spark.read.parquet(f"{out}/interactions")
    assert res.stats["n_rows"] == inter.count() > 0
    assert sum(res.sizes.values()) == inter.count()
    assert set(res.seconds) == {"prepare", "preprocess", "features", "dataset", "train"}


def test_interactions_sorted_files(spark, run):
    _, out, _ = run
    df = spark.read.parquet(f"{out}/interactions").select(
        "event_order", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))
    per = df.groupBy("f").agg(F.min("event_order").alias("lo"), F.max("event_order").alias("hi")).collect()
    spans = sorted((r["lo"], r["hi"]) for r in per)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # disjoint ranges per file


def test_reports_written(spark, run):
    cfg, out, res = run
    bounds = spark.read.json(f"{out}/reports/bounds").first()
    assert (bounds["train_end"], bounds["val_end"]) == (res.bounds.train_end, res.bounds.val_end)
    meta = json.loads(spark.read.json(f"{out}/reports/dataset_meta").first()["meta"])
    assert len(meta["num_features"]) == 36 and len(meta["cat_features"]) == 5
    track = spark.read.parquet(f"{out}/reports/tracking")
    assert {r["stage"] for r in track.select("stage").distinct().collect()} == {
        "prepare", "preprocess", "features", "dataset", "train"}
    fi = spark.read.option("header", True).csv(f"{out}/reports/feature_importance")
    assert fi.count() == 41
    om = spark.read.json(f"{out}/reports/offline_metrics")
    assert {r["split"] for r in om.select("split").distinct().collect()} == {"val", "test"}
    curve = spark.read.json(f"{out}/reports/training_curve").orderBy("iteration").collect()
    assert curve and curve[-1]["iteration"] == cfg.model.max_iter


def test_single_stages_read_what_earlier_ones_wrote(spark, run):
    cfg, out, res = run
    raw = shard_tree.cached_tree(spark, SF)
    again = job.run(spark, raw, out, cfg, ("train",))
    assert again.metrics == res.metrics and set(again.seconds) == {"train"}
    assert again.meta.sizes == res.sizes
    fresh = scratch_path(spark, "job-fresh")
    for stage, need in (("train", "dataset"), ("dataset", "prepare"), ("preprocess", "prepare"),
                        ("features", "preprocess")):
        with pytest.raises(FileNotFoundError, match=need):
            job.run(spark, raw, fresh, cfg, (stage,))
    job.run(spark, raw, fresh, cfg, ("prepare",))
    man = spark.read.parquet(f"{fresh}/manifest")
    assert man.where("category = 'interactions'").count() > 0
    with pytest.raises(ValueError):
        job.run(spark, raw, out, cfg, ("tran",))


def test_config_from_file_and_overrides(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"model": {"max_iter": 7}, "columns": {"feedback": ["like"]},
                                "label": {"weights": {"like": 1.5}}}))
    cfg = job.read_config(spark, str(path), ["model.max_depth=3", "split.train_frac=0.7"])
    assert (cfg.model.max_iter, cfg.model.max_depth, cfg.split.train_frac) == (7, 3, 0.7)
    assert cfg.columns.feedback == ("like",) and cfg.label.weights == (("like", 1.5),)
    for bad in (["model.trees=3"], ["nope.x=1"], ["model=3"]):
        with pytest.raises(ValueError):
            job.read_config(spark, None, bad)


def test_dataset_layout(spark, run):
    from rankbeam.operators import checks

    cfg, out, _ = run
    rows = checks.group_runs_per_file(spark.read.parquet(f"{out}/dataset"), cfg).collect()
    assert rows and all(r["broken_runs"] == 0 and r["order_breaks"] == 0 for r in rows)


def test_load_split_and_model(spark, run):
    cfg, out, res = run
    val = ds.load_split(spark, f"{out}/dataset", "val", res.meta, cfg)
    assert val.count() == res.sizes["val"]
    capped = ds.load_split(spark, f"{out}/dataset", "train", res.meta, cfg, max_rows=50)
    assert 0 < capped.count() <= 50
    model = rkr.load(f"{out}/model")
    scored = rkr.score(model, val.withColumn(SPLIT, F.lit("val")), res.meta, cfg)
    assert scored.where(F.col("prediction").isNull()).count() == 0


def test_interactions_local_sort_option(spark, run):
    from rankbeam.plans import sinks

    _, out, _ = run
    inter = spark.read.parquet(f"{out}/interactions")
    path = sinks.write_interactions(inter.repartition(3), scratch_path(spark, "loc"), globally=False)
    df = spark.read.parquet(path).select("event_order", F.col("_metadata.file_path").alias("f"),
                                         F.col("_metadata.row_index").alias("r"))
    from pyspark.sql import Window

    w = Window.partitionBy("f").orderBy("r")
    back = (df.withColumn("prev", F.lag("event_order").over(w))
            .where(F.col("prev") > F.col("event_order")).count())
    assert back == 0 and df.count() == inter.count()


def test_layout_check_sees_broken_layouts(spark, run):
    """Users spread over files, or interleaved in one, are broken runs; a user that ends
    one file and begins the next is not."""
    from rankbeam.operators import checks

    cfg, out, _ = run
    data = spark.read.parquet(f"{out}/dataset")

    def broken(df, name):
        path = scratch_path(spark, name)
        df.write.partitionBy(SPLIT).parquet(path)
        rows = checks.group_runs_per_file(spark.read.parquet(path), cfg).collect()
        return sum(r["broken_runs"] for r in rows), sum(r["order_breaks"] for r in rows)

    spread = data.repartition(3, "event_order").sortWithinPartitions(SPLIT, "user_id", "event_order")
    assert broken(spread, "spread")[0] > 0
    mixed = data.coalesce(1).sortWithinPartitions(SPLIT, "item_id")
    assert broken(mixed, "mixed")[0] > 0
    backwards = data.coalesce(1).sortWithinPartitions(SPLIT, "user_id", F.desc("event_order"))
    assert broken(backwards, "backwards")[1] > 0
    cut = spark.createDataFrame([(1, 1, "val"), (1, 2, "val")], "user_id long, event_order long, split string")
    more = spark.createDataFrame([(1, 3, "val"), (2, 4, "val")], "user_id long, event_order long, split string")
    path = scratch_path(spark, "cut")
    cut.coalesce(1).write.parquet(f"{path}/a")
    more.coalesce(1).write.parquet(f"{path}/b")
    both = spark.read.parquet(f"{path}/a", f"{path}/b")
    assert [r["broken_runs"] for r in checks.group_runs_per_file(both, cfg).collect()] == [0]


def test_stages_leave_nothing_persisted(spark, tmp_path):
    """Everything that a stage persists is released when its product is written; the
    embedding scalar is the outcome, not the setting."""
    raw = shard_tree.cached_tree(spark, SF)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    out = scratch_path(spark, "job")
    cfg = td.SMOKE_CFG.with_model(loss="lambdarank", max_iter=2, max_depth=2, early_stop=False)
    res = job.run(spark, raw, out, cfg)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert res.metrics["val"] and (res.meta.num_features[-1] == "emb_cos")
    tracked = {(r["stage"], r["name"]): r["value"] for r in spark.read.parquet(f"{out}/reports/tracking").collect()}
    assert tracked["dataset", "emb_built"] == 1.0 and tracked["features", "rows_user"] > 0
    assert tracked["preprocess", "n_rows"] == spark.read.parquet(f"{out}/interactions").count()
    none = job.run_dataset(spark, raw, out, replace(cfg, features=replace(cfg.features, use_embeddings=False)),
                           job.RunResult())
    assert none["emb_built"] == 0.0


def test_cut_points_of_the_metric_are_free(spark, run):
    """eval.ks without 10: the best iteration is chosen by the largest."""
    cfg, out, _ = run
    res = job.RunResult()
    job.run_train(spark, None, out, replace(cfg, eval=replace(cfg.eval, ks=(5, 20))), res)
    assert "ndcg_at_20" in res.metrics["val"] and "ndcg_at_10" not in res.metrics["val"]
