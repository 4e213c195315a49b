"""Registered queries over the provided test tables (adapter A).

Every query reads the given tables through ``sources.adapters`` and runs the
library's own operators on the whole tables. Computed doubles are cast to
float32 in the final projection only, so the DuckDB oracle can compare values
without decimal rounding ties.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import EVENT_ORDER, LABEL, SPLIT, WATCH_RATIO, Config, Sources
from ..functions import columns as fc
from ..functions import vectors as fv
from ..operators import clean as cl
from ..operators import dataset as ds
from ..operators import features as ft
from ..operators import ranking as rk
from ..operators import vectors as vx
from ..sources import adapters as ad
from ..sources import catalog as cat
from ..sources import embeddings as emb
from ..sources import shard_tree
from ..sources import shards as sh

# Thresholds that bite on the provided tables (see FIXTURES.md).
TD_CFG = Config().with_cleaning(
    max_timespent_sec=200.0, min_user_interactions=60, min_item_interactions=95,
).with_model(loss="pointwise", max_iter=20, max_depth=5, step_size=0.1, metric_period=5, early_stop=False)
# Smoke thresholds for the tiny sf0.001 tables used by ``entry``.
SMOKE_CFG = Config().with_cleaning(
    max_timespent_sec=200.0, min_user_interactions=20, min_item_interactions=5,
)
SAMPLE_FRACTION = 0.3
METRIC_K = 10
HEAD_ROWS = 1000
# The skewed author of one query, and the rows from which its keys count as hot.
HOT_AUTHOR, HOT_KEY_ROWS = "Brand#00", 200
RANDOM_SEED = 42
LAYOUT_FILES = 7

FLAGS = list(TD_CFG.columns.feedback)


def f32(c):
    """Computed doubles are compared at float32 precision (no decimal ties)."""
    return c.cast("float")


def r6(name: str, alias: str | None = None):
    return f32(F.col(name)).alias(alias or name)


def _f32_doubles(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float") and f.name not in keep:
            out.append(r6(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ---------------------------------------------------------------------------
# Shared building blocks
# ---------------------------------------------------------------------------

def norm_log(spark, sf_dir, cfg=TD_CFG):
    return cl.normalise_feedback(ad.events_log(spark, sf_dir), cfg)


def enriched(spark, sf_dir, cfg=TD_CFG):
    return cl.enrich(norm_log(spark, sf_dir, cfg), ad.item_meta(spark, sf_dir),
                     ad.user_meta(spark, sf_dir), cfg)


def cleaned(spark, sf_dir, cfg=TD_CFG):
    return cl.add_watch_ratio(cl.clean(enriched(spark, sf_dir, cfg), cfg), cfg)


def interactions(spark: SparkSession, sf_dir: str, cfg: Config = TD_CFG, items: DataFrame | None = None) -> DataFrame:
    """The preprocess stage on adapter A (lazy)."""
    return cl.preprocess(
        ad.events_log(spark, sf_dir), items if items is not None else ad.item_meta(spark, sf_dir),
        ad.user_meta(spark, sf_dir), cfg,
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """A stage's product written to the shared folder and read back, as the job hands it on.

    A persisted frame is not found again where a join has it on both sides (the right side's
    columns are renamed), so each such place would run the stage and its broadcasts anew.
    """
    from ..plans.sinks import write_table
    from ..session import scratch_path

    spark = df.sparkSession
    return spark.read.schema(df.schema).parquet(write_table(df, scratch_path(spark, name)))


class Stage:
    """Interactions (written once), bounds and feature tables of one run.

    Bounds, feature tables, vectors and profiles are made when first asked for, once.
    """

    def __init__(self, spark, sf_dir, cfg=TD_CFG, items=None):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg
        self.inter = stored(interactions(spark, sf_dir, cfg, items), "stage")

    @cached_property
    def bounds(self):
        return ft.split_bounds(self.inter, self.cfg)

    @cached_property
    def feats(self):
        return ft.build_aggregates(self.inter, self.bounds, self.cfg)

    def split(self) -> DataFrame:
        return ft.temporal_split(self.inter, self.bounds)

    def vectors(self) -> DataFrame:
        return ad.item_vectors(self.spark, self.sf_dir)

    @cached_property
    def _unit(self) -> DataFrame:
        return vx.unit_vectors(self.vectors(), self.cfg, self.inter)

    @cached_property
    def _dim(self) -> int:
        return vx.vector_width(self.vectors(), self.cfg)

    @cached_property
    def _profiles(self) -> DataFrame:
        return vx.user_profiles(self.inter, self._unit, self.bounds.train_end, self.cfg, self._dim)

    def unit(self) -> DataFrame:
        return self._unit

    def dim(self) -> int:
        return self._dim

    def profiles(self) -> DataFrame:
        return self._profiles

    def scored(self, split: str | tuple[str, ...] = "val") -> DataFrame:
        """Events of a split scored by the train-window item mean label."""
        splits = (split,) if isinstance(split, str) else tuple(split)
        ev = ft.temporal_split(self.inter.where(ft.split_predicate(self.bounds, splits)), self.bounds)
        score = self.feats.item.select(self.cfg.columns.item_id,
                                       F.col("item_mean_label").cast("float").cast("double").alias("score"))
        return ev.join(score, self.cfg.columns.item_id, "left")


# ---------------------------------------------------------------------------
# Preprocess stage
# ---------------------------------------------------------------------------

def q_feedback_normalise(spark, sf_dir):
    return norm_log(spark, sf_dir).select(EVENT_ORDER, "user_id", "item_id", *FLAGS)


def q_enrich_events(spark, sf_dir):
    return enriched(spark, sf_dir).select(EVENT_ORDER, "user_id", "item_id", "duration",
                                          "author_id", "age", "gender", "geo")


def q_clean_events(spark, sf_dir):
    return cl.clean(enriched(spark, sf_dir), TD_CFG).select(
        EVENT_ORDER, "user_id", "item_id", "timespent", "duration")


def q_watch_ratio(spark, sf_dir):
    return cleaned(spark, sf_dir).select(EVENT_ORDER, WATCH_RATIO)


def q_min_activity(spark, sf_dir):
    return cl.activity_filter(cleaned(spark, sf_dir), TD_CFG).select(EVENT_ORDER, "user_id", "item_id")


def q_graded_label(spark, sf_dir):
    return interactions(spark, sf_dir).select(EVENT_ORDER, LABEL, WATCH_RATIO, "dislike")


def q_user_sample(spark, sf_dir):
    cfg = TD_CFG.with_sample(user_fraction=SAMPLE_FRACTION, seed=RANDOM_SEED)
    return cl.sample_users(enriched(spark, sf_dir, cfg), cfg).select(EVENT_ORDER, "user_id")


def q_stage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = cl.stage_stats(interactions(spark, sf_dir), TD_CFG)
    return s.select("n_rows", "n_users", "n_items",
                    r6("label_mean"), r6("label_pos_share"), r6("watch_ratio_mean"))


# ---------------------------------------------------------------------------
# Features stage
# ---------------------------------------------------------------------------

def q_split_bounds(spark, sf_dir):
    st = Stage(spark, sf_dir)
    return ft.bounds_frame(spark, st.bounds)


def q_temporal_split(spark, sf_dir):
    return Stage(spark, sf_dir).split().select(EVENT_ORDER, SPLIT)


def q_split_sizes(spark, sf_dir):
    return ft.split_sizes(Stage(spark, sf_dir).split())


def q_user_features(spark, sf_dir):
    return _f32_doubles(Stage(spark, sf_dir).feats.user)


def q_item_features(spark, sf_dir):
    return _f32_doubles(Stage(spark, sf_dir).feats.item)


def q_author_features(spark, sf_dir):
    return _f32_doubles(Stage(spark, sf_dir).feats.author)


def q_user_author_features(spark, sf_dir):
    return _f32_doubles(Stage(spark, sf_dir).feats.ua)


# ---------------------------------------------------------------------------
# Embedding feature
# ---------------------------------------------------------------------------

def q_embedding_normalise(spark, sf_dir):
    """P15 + J6: every component of every unit vector."""
    u = Stage(spark, sf_dir).unit()
    return (u.select("item_id", F.posexplode("vec").alias("i", "x"))
            .select("item_id", (F.col("i") + 1).cast("bigint").alias("i"), f32(F.col("x")).alias("x")))


def q_user_profile(spark, sf_dir):
    """P14 + A10: every component of every user profile."""
    p = Stage(spark, sf_dir).profiles()
    return (p.select("user_id", "n_votes", F.posexplode("profile").alias("i", "x"))
            .select("user_id", "n_votes", (F.col("i") + 1).cast("bigint").alias("i"),
                    f32(F.col("x")).alias("x")))


def q_emb_cos(spark, sf_dir):
    st = Stage(spark, sf_dir)
    out = vx.attach_cosine(st.inter.select(EVENT_ORDER, "user_id", "item_id"), st.profiles(),
                           st.unit(), st.cfg, st.dim())
    return out.select(EVENT_ORDER, f32(fc.nan_to_null(F.col(vx.EMB_COS)))
                      .alias("emb_cos"))


def q_stored_cosine(spark, sf_dir):
    """S13 + J5: the per-event cosine written as a table, then joined back by event_order."""
    from ..plans.sinks import write_cosine
    from ..session import scratch_path

    st = Stage(spark, sf_dir)
    base = st.inter.select(EVENT_ORDER, "user_id", "item_id")
    cos = vx.attach_cosine(base, st.profiles(), st.unit(), st.cfg, st.dim())
    path = write_cosine(cos, scratch_path(spark, "cosine"))
    out = vx.attach_stored_cosine(st.inter.select(EVENT_ORDER), spark.read.parquet(path))
    return out.select(EVENT_ORDER, f32(fc.nan_to_null(F.col(vx.EMB_COS))).alias("emb_cos"))


def q_profile_coverage(spark, sf_dir):
    st = Stage(spark, sf_dir)
    return vx.profile_coverage(st.inter, st.profiles(), st.cfg)


def q_id_lookup(spark, sf_dir):
    ids = ad.item_vectors(spark, sf_dir).select("item_id")
    query = norm_log(spark, sf_dir).select("item_id").distinct()
    return vx.id_lookup(ids, query, "item_id")


# ---------------------------------------------------------------------------
# Dataset stage
# ---------------------------------------------------------------------------

def _dataset(spark, sf_dir):
    st = Stage(spark, sf_dir)
    return ds.assemble(st.inter, st.feats, st.bounds, st.cfg, st.vectors())


def q_assemble_features(spark, sf_dir):
    return _features_of(*_dataset(spark, sf_dir))


def q_assemble_features_skewed(spark, sf_dir):
    """J4 by shuffle joins alone: one author holds about a third of the log, others are null."""
    cfg = replace(TD_CFG, scale=replace(TD_CFG.scale, broadcast_max_rows=0, hot_key_rows=HOT_KEY_ROWS))
    i = F.col("item_id")
    items = ad.item_meta(spark, sf_dir).withColumn("author_id", F.when(i % 3 == 0, HOT_AUTHOR).when(
        i % 7 != 1, F.col("author_id")))
    st = Stage(spark, sf_dir, cfg, items)
    return _features_of(*ds.assemble(st.inter, st.feats, st.bounds, cfg, st.vectors()))


def _features_of(d, meta):
    d = d.withColumn("emb_cos", fc.nan_to_null(F.col("emb_cos")))
    return _f32_doubles(d.select(*[F.col(c).cast("double") if c in meta.num_features else F.col(c)
                                     for c in d.columns]))


def flagship(spark, sf_dir, cfg=SMOKE_CFG):
    """The model-ready dataset (all stages up to assembly) on adapter A."""
    st = Stage(spark, sf_dir, cfg)
    d, _ = ds.assemble(st.inter, st.feats, st.bounds, cfg, st.vectors())
    return d


def q_dur_diff(spark, sf_dir):
    d, _ = _dataset(spark, sf_dir)
    return d.select(EVENT_ORDER, r6("dur_diff"))


def q_categorical_normalise(spark, sf_dir):
    d, meta = _dataset(spark, sf_dir)
    return d.select(EVENT_ORDER, *meta.cat_features)


def q_grouped_split(spark, sf_dir):
    """O2 layout written to the shared scratch folder and checked per file."""
    from ..plans.sinks import write_grouped_splits
    from ..operators.checks import group_runs_per_file

    d, _ = _dataset(spark, sf_dir)
    path = write_grouped_splits(d, TD_CFG)
    return group_runs_per_file(spark.read.parquet(path), TD_CFG)


def q_dataset_invariants(spark, sf_dir):
    """SURVEY 5.3 checks over the whole interactions and dataset tables."""
    from ..operators.checks import invariant_counts

    st = Stage(spark, sf_dir)
    d, meta = ds.assemble(st.inter, st.feats, st.bounds, st.cfg, st.vectors())
    return invariant_counts(st.inter, d, meta, st.bounds.train_end, st.bounds.val_end, st.cfg)


def q_load_split(spark, sf_dir):
    """The dataset written per split, then the val split loaded back."""
    from ..plans.sinks import write_grouped_splits

    d, meta = _dataset(spark, sf_dir)
    path = write_grouped_splits(d, TD_CFG)
    val = ds.load_split(spark, path, "val", meta, TD_CFG)
    val = val.withColumn("emb_cos", fc.nan_to_null(F.col("emb_cos")))
    return val.select(*[f32(F.col(c).cast("double")).alias(c) if c in meta.num_features else F.col(c)
                        for c in val.columns])


def q_head_whole_groups(spark, sf_dir):
    d, _ = _dataset(spark, sf_dir)
    train = d.where(F.col(SPLIT) == "train")
    return ds.head_whole_groups(train, HEAD_ROWS, TD_CFG).select("user_id", EVENT_ORDER, LABEL)


# ---------------------------------------------------------------------------
# Ranking metrics (score: train-window item mean label on the val split)
# ---------------------------------------------------------------------------

def q_rank_in_group(spark, sf_dir):
    sc = Stage(spark, sf_dir).scored().select("user_id", EVENT_ORDER, "score")
    return rk.rank_in_group(sc, ["user_id"], "score", EVENT_ORDER).select("user_id", EVENT_ORDER, "pos")


def q_running_hits(spark, sf_dir):
    sc = Stage(spark, sf_dir).scored().select("user_id", EVENT_ORDER, "score", LABEL)
    out = rk.running_hits(sc, ["user_id"], LABEL, "score", EVENT_ORDER, TD_CFG.eval.binary_threshold)
    return out.select("user_id", EVENT_ORDER, "pos", "cum_hits")


def q_ideal_rank(spark, sf_dir):
    sc = Stage(spark, sf_dir).scored().select("user_id", EVENT_ORDER, LABEL)
    return rk.ideal_rank(sc, ["user_id"], LABEL, EVENT_ORDER).select("user_id", EVENT_ORDER, "ideal_pos")


def _single(metric, gain="exp", k=METRIC_K):
    def q(spark, sf_dir):
        sc = Stage(spark, sf_dir).scored()
        out = rk.single_metric(sc, metric, ["user_id"], LABEL, "score", EVENT_ORDER,
                               k=None if metric == "gauc" else k,
                               thr=TD_CFG.eval.binary_threshold, gain=gain)
        return _f32_doubles(out)
    q.__name__ = f"q_{metric}"
    return q


def q_ranking_metrics(spark, sf_dir):
    sc = Stage(spark, sf_dir).scored()
    out = rk.ranking_metrics(sc, ["user_id"], LABEL, "score", EVENT_ORDER,
                             ks=TD_CFG.eval.ks, thr=TD_CFG.eval.binary_threshold)
    return _f32_doubles(out)


def q_metrics_by_split(spark, sf_dir):
    """T4-style evaluation of val and test in one pass (split in the group key)."""
    sc = Stage(spark, sf_dir).scored(("val", "test"))
    out = rk.ranking_metrics(sc, ["user_id"], LABEL, "score", EVENT_ORDER,
                             ks=TD_CFG.eval.ks, thr=TD_CFG.eval.binary_threshold, by=[SPLIT])
    return _f32_doubles(out)


def q_random_baseline(spark, sf_dir):
    """Deterministic pseudo-random scores (md5 of event_order|seed)."""
    st = Stage(spark, sf_dir)
    ev = ft.temporal_split(st.inter.where(ft.split_predicate(st.bounds, "val")), st.bounds)
    ev = ev.withColumn("score", fc.portable_hash_bucket(F.col(EVENT_ORDER), RANDOM_SEED, 1_000_003)
                       .cast("double"))
    out = rk.ranking_metrics(ev, ["user_id"], LABEL, "score", EVENT_ORDER, ks=(METRIC_K,),
                             thr=TD_CFG.eval.binary_threshold)
    return _f32_doubles(out.select(f"ndcg_at_{METRIC_K}", f"map_at_{METRIC_K}", "gauc", "n_groups"))


# ---------------------------------------------------------------------------
# Sources: the raw folder layout written from adapter A, ingested by the job
# ---------------------------------------------------------------------------

def _manifest(spark, sf_dir):
    root = shard_tree.cached_tree(spark, sf_dir)
    return root, cat.manifest(cat.list_files(spark, root))


def q_source_catalog(spark, sf_dir):
    """Categories (validated), shard folders, week numbers and their order."""
    _, man = _manifest(spark, sf_dir)
    cat.validate(man)
    out = man.select("category", "shard", "week").distinct()
    w = Window.partitionBy("category").orderBy("week", "shard")
    return out.withColumn("shard_ord", F.dense_rank().over(w).cast("bigint"))


def q_event_order(spark, sf_dir):
    """S6 + S7: global row index over shards in week order (file offsets)."""
    root, man = _manifest(spark, sf_dir)
    log = sh.with_row_index(sh.scan(spark, cat.paths(man, "interactions")), root)
    return log.select(EVENT_ORDER, "user_id", "item_id", "timespent")


def q_meta_scan(spark, sf_dir):
    """Tolerant metadata projection (a wanted column that does not exist is skipped)."""
    _, man = _manifest(spark, sf_dir)
    return sh.scan_meta(spark, cat.paths(man, "users"), ["user_id", "age", "gender", "geo", "region"])


def q_npz_embeddings(spark, sf_dir):
    """NPZ archives decoded on the executors."""
    _, man = _manifest(spark, sf_dir)
    v = emb.load_vectors(spark, cat.paths(man, "embeddings"), cat.paths(man, "items"))
    return _components(v)


def _components(vectors: DataFrame) -> DataFrame:
    return (vectors.select("item_id", F.posexplode("embedding").alias("i", "x"))
            .select("item_id", (F.col("i") + 1).cast("bigint").alias("i"), f32(F.col("x")).alias("x")))


def q_parquet_embeddings(spark, sf_dir):
    """Item vectors from a Parquet file of the raw folder instead of an archive."""
    from ..session import scratch_path

    path = scratch_path(spark, "vectors") + "/item_embeddings.parquet"
    ad.item_vectors(spark, sf_dir).write.parquet(path)
    return _components(emb.load_vectors(spark, [path], []))


def q_shard_stage_stats(spark, sf_dir):
    """Preprocess from the raw folder: S1-S8 then P1-P5, J1-J3, A1, A2 (sampling off)."""
    from .job import load_inputs

    root, man = _manifest(spark, sf_dir)
    inp = load_inputs(spark, root, man, TD_CFG)
    inter = cl.preprocess(inp.log, inp.items, inp.users, TD_CFG)
    s = cl.stage_stats(inter, TD_CFG)
    return s.select("n_rows", "n_users", "n_items",
                    r6("label_mean"), r6("label_pos_share"), r6("watch_ratio_mean"))


# ---------------------------------------------------------------------------
# Ranker (MLlib): rows-only checks, no SQL oracle
# ---------------------------------------------------------------------------

_FITS: dict = {}


def _fit(spark, sf_dir):
    from ..operators import ranker as rkr

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITS:
        d, meta = _dataset(spark, sf_dir)
        d = stored(d, "fit")
        res = rkr.fit_and_evaluate(d, meta, TD_CFG, curve=True)
        _FITS[key] = (d, meta, res)
    return _FITS[key]


def q_ranker_metrics(spark, sf_dir):
    """Fit on train, val and test metrics at the best validation iteration:
    group counts, how many metrics lie in [0, 1], and whether the ranker beats random
    scores on val by NDCG@10 (said on both rows)."""
    d, meta, res = _fit(spark, sf_dir)
    noise = rk.ranking_metrics(
        d.where(F.col(SPLIT) == "val").withColumn("_noise", fc.portable_hash_bucket(
            F.col(EVENT_ORDER), RANDOM_SEED, 1_000_003).cast("double")),
        [meta.group], LABEL, "_noise", EVENT_ORDER, ks=(METRIC_K,),
        thr=TD_CFG.eval.binary_threshold).first()[f"ndcg_at_{METRIC_K}"]
    beats = res.metrics["val"][f"ndcg_at_{METRIC_K}"] > noise
    rows = []
    for split, m in sorted(res.metrics.items()):
        values = [v for k, v in m.items() if not k.startswith("n_")]
        rows.append((split, int(m["n_groups"]), len(values), sum(0 <= v <= 1 for v in values),
                     beats))
    return spark.createDataFrame(rows, "split string, n_groups long, n_metrics long, "
                                       "n_in_range long, beats_random_on_val boolean")


def q_ranking_fit(spark, sf_dir):
    """The ranking loss on the train split: users ranked, trees, and whether the lists it
    was fitted on are ordered better than at random (val labels of these tables are noise)."""
    from ..operators import ranker as rkr

    cfg = TD_CFG.with_model(loss="lambdarank", max_iter=4, max_depth=4)
    d, meta = _dataset(spark, sf_dir)
    d = stored(d, "fit")
    model = rkr.fit(d, meta, cfg)
    train = rkr.score(model, d.where(F.col(SPLIT) == "train"), meta, cfg).withColumn(
        "_noise", fc.portable_hash_bucket(F.col(EVENT_ORDER), RANDOM_SEED, 1_000_003).cast("double"))
    got, noise = (rk.ranking_metrics(train, [meta.group], LABEL, by, EVENT_ORDER, ks=(METRIC_K,),
                                     thr=cfg.eval.binary_threshold) for by in ("prediction", "_noise"))
    return got.crossJoin(noise.select(F.col(f"ndcg_at_{METRIC_K}").alias("_random"))).select(  # one row each
        "n_groups", F.lit(len(model.stages[-1].trees)).cast("long").alias("n_trees"),
        (F.col(f"ndcg_at_{METRIC_K}") > F.col("_random")).alias("beats_random_on_train"))


def q_training_curve(spark, sf_dir):
    """T5: the iterations of the staged curve on val, which one is best by NDCG@10, and
    whether the last one has the full model's metrics."""
    _, _, res = _fit(spark, sf_dir)
    top = max(r["ndcg_at_10"] for r in res.curve)
    full = res.all_trees_metrics["val"]
    rows = [(r["iteration"], (r["iteration"] == res.best_iteration) == (
        r["ndcg_at_10"] == top and all(x["ndcg_at_10"] < top for x in res.curve[:i])),
        i + 1 < len(res.curve) or all(r[k] == v for k, v in full.items()))
        for i, r in enumerate(res.curve)]
    return spark.createDataFrame(rows, "iteration int, best_is_argmax boolean, ends_at_model boolean")


def q_feature_importance(spark, sf_dir):
    """Every feature once, its importance not negative, all adding up to one."""
    imp = _fit(spark, sf_dir)[2].importances
    total = imp.agg(F.sum("importance")).first()[0]
    return imp.select("feature", (F.col("importance") >= 0).alias("not_negative"),
                      F.lit(abs(total - 1.0) < 1e-6).alias("adds_to_one"))


def q_top_importances(spark, sf_dir):
    """The ten most important features, descending (the limit is the report)."""
    imp = _fit(spark, sf_dir)[2].importances
    top = imp.orderBy(F.desc("importance"), "feature").limit(10)
    w = Window.orderBy(F.desc("importance"), "feature")
    low = top.agg(F.min("importance")).first()[0]
    above = imp.where(F.col("importance") > low).count()
    return top.select(F.row_number().over(w).alias("place"), F.lit(above < 10).alias("holds_the_top"))


def q_model_roundtrip(spark, sf_dir):
    """Save, load, rescore; counts rows whose prediction changed."""
    from ..operators import ranker as rkr
    from ..session import scratch_path

    d, meta, res = _fit(spark, sf_dir)
    path = scratch_path(spark, "model")
    rkr.save(res.model, path)
    back = rkr.load(path)
    val = d.where(F.col(SPLIT) == "val")
    a = rkr.score(res.model, val, meta, TD_CFG).select(EVENT_ORDER, F.col("prediction").alias("p1"))
    b = rkr.score(back, val, meta, TD_CFG).select(EVENT_ORDER, F.col("prediction").alias("p2"))
    j = a.join(b, EVENT_ORDER)
    return j.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum((F.abs(F.col("p1") - F.col("p2")) > 1e-12).cast("long")).alias("n_changed"))


def q_max_shards(spark, sf_dir):
    """Rows and users of each week when only the first two weeks are kept."""
    src = Sources(max_shards=2)
    root = shard_tree.cached_tree(spark, sf_dir)
    man = cat.manifest(cat.list_files(spark, root, src), src)
    log = sh.scan(spark, cat.paths(man, "interactions"))
    week = F.regexp_extract(F.col("_metadata.file_path"), r"week_(\d+)", 1).cast("int")
    return (log.select(week.alias("week"), "user_id").groupBy("week")
            .agg(F.count("*").alias("n_rows"), F.count_distinct("user_id").alias("n_users")))


def q_manifest_roundtrip(spark, sf_dir):
    """The manifest written by the prepare stage and read back."""
    from ..session import scratch_path
    from . import job

    root = shard_tree.cached_tree(spark, sf_dir)
    out = scratch_path(spark, "manifest")
    job.run(spark, root, out, TD_CFG, ("prepare",))
    man = spark.read.parquet(f"{out}/manifest")
    w = Window.partitionBy("category").orderBy("week", "shard")
    return man.select("category", "shard", "week").distinct().withColumn(
        "shard_ord", F.dense_rank().over(w).cast("bigint"))


def q_interactions_layout(spark, sf_dir):
    """O1: the interactions sink read back: rows, range, files whose range overlaps an
    earlier file's, rows out of order in their file."""
    from ..operators.checks import sorted_files
    from ..session import scratch_path
    from .sinks import write_interactions

    path = write_interactions(Stage(spark, sf_dir).inter, scratch_path(spark, "interactions"), LAYOUT_FILES)
    return sorted_files(spark.read.parquet(path))


def _job(spark, sf_dir) -> str:
    """The job from raw shards to the dataset; its output folder."""
    from ..session import scratch_path
    from . import job

    out = scratch_path(spark, "job")
    job.run(spark, shard_tree.cached_tree(spark, sf_dir), out, TD_CFG, job.STAGES[:-1])
    return out


def q_dataset_meta(spark, sf_dir):
    """The dataset stage's report as rows: names with their places, sizes, bounds."""
    from .job import load_meta

    m = load_meta(spark, _job(spark, sf_dir))
    rows = [("role", n, getattr(m, n), None) for n in ("label", "group", "item_id", "event_order")]
    rows += [(kind, n, None, k) for kind, names in (("numeric", m.num_features), ("categorical", m.cat_features))
             for k, n in enumerate(names)]
    rows += [(kind, n, None, v) for kind, got in (("size", m.sizes), ("bound", m.split_bounds))
             for n, v in got.items()]
    return spark.createDataFrame(rows, "kind string, name string, text string, value long").select(
        "kind", "name", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("value", F.lit(-1)).alias("value"))


def q_tracking_scalars(spark, sf_dir):
    """The scalars that the stages tracked."""
    rows = spark.read.parquet(f"{_job(spark, sf_dir)}/reports/tracking")
    return rows.where("name <> 'n_files'").select("stage", "name", f32(F.col("value")).alias("value"))


QUERIES = {
    "interactions_layout": q_interactions_layout,
    "dataset_meta": q_dataset_meta,
    "tracking_scalars": q_tracking_scalars,
    "assemble_features_skewed": q_assemble_features_skewed,
    "feedback_normalise": q_feedback_normalise,
    "enrich_events": q_enrich_events,
    "clean_events": q_clean_events,
    "watch_ratio": q_watch_ratio,
    "min_activity": q_min_activity,
    "graded_label": q_graded_label,
    "user_sample": q_user_sample,
    "stage_stats": q_stage_stats,
    "split_bounds": q_split_bounds,
    "temporal_split": q_temporal_split,
    "split_sizes": q_split_sizes,
    "user_features": q_user_features,
    "item_features": q_item_features,
    "author_features": q_author_features,
    "user_author_features": q_user_author_features,
    "embedding_normalise": q_embedding_normalise,
    "user_profile": q_user_profile,
    "emb_cos": q_emb_cos,
    "profile_coverage": q_profile_coverage,
    "stored_cosine": q_stored_cosine,
    "id_lookup": q_id_lookup,
    "assemble_features": q_assemble_features,
    "dur_diff": q_dur_diff,
    "categorical_normalise": q_categorical_normalise,
    "grouped_split": q_grouped_split,
    "head_whole_groups": q_head_whole_groups,
    "load_split": q_load_split,
    "dataset_invariants": q_dataset_invariants,
    "rank_in_group": q_rank_in_group,
    "running_hits": q_running_hits,
    "ideal_rank": q_ideal_rank,
    "ndcg_at_k": _single("ndcg"),
    "ndcg_linear_at_k": _single("ndcg", gain="linear"),
    "map_at_k": _single("map"),
    "mrr_at_k": _single("mrr"),
    "hitrate_at_k": _single("hitrate"),
    "recall_at_k": _single("recall"),
    "precision_at_k": _single("precision"),
    "gauc": _single("gauc"),
    "ranking_metrics": q_ranking_metrics,
    "metrics_by_split": q_metrics_by_split,
    "random_baseline": q_random_baseline,
    "source_catalog": q_source_catalog,
    "event_order": q_event_order,
    "meta_scan": q_meta_scan,
    "npz_embeddings": q_npz_embeddings,
    "parquet_embeddings": q_parquet_embeddings,
    "shard_stage_stats": q_shard_stage_stats,
    "ranker_metrics": q_ranker_metrics,
    "ranking_fit": q_ranking_fit,
    "training_curve": q_training_curve,
    "feature_importance": q_feature_importance,
    "top_importances": q_top_importances,
    "model_roundtrip": q_model_roundtrip,
    "max_shards": q_max_shards,
    "manifest_roundtrip": q_manifest_roundtrip,
}

