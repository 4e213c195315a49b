"""The whole job: prepare -> preprocess -> features -> dataset -> train.

Stages are plain functions on DataFrames inside one SparkSession. Each stage
writes its product to the output folder (a lineage cut that survives lost
executors, and the same hand-off the reference uses), and the next stage
reads it back, so filters and column pruning still reach the Parquet scans.

    spark-submit --py-files rankbeam.zip scripts/run_job.py RAW_DIR OUT_DIR [--stages ...]
        [--config settings.json] [--set model.max_iter=100 ...]
"""

from __future__ import annotations

import argparse
import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..config import SPLIT, Config
from ..operators import clean as cl
from ..operators import dataset as ds
from ..operators import features as ft
from ..operators.joins import releasing
from ..operators.vectors import EMB_COS
from ..sources import catalog as cat
from ..sources import embeddings as emb
from ..sources import shards as sh
from . import sinks

STAGES = ("prepare", "preprocess", "features", "dataset", "train")


@dataclass
class Inputs:
    log: DataFrame
    items: DataFrame | None
    users: DataFrame | None
    vectors: DataFrame | None
    manifest: object


@dataclass
class RunResult:
    stats: dict = field(default_factory=dict)
    bounds: ft.Bounds | None = None
    sizes: dict = field(default_factory=dict)
    meta: ds.DatasetMeta | None = None
    metrics: dict = field(default_factory=dict)
    seconds: dict = field(default_factory=dict)


def prepare(spark: SparkSession, raw_dir: str, cfg: Config) -> "cat.Listing":
    """The manifest of the raw folder, collected once and validated."""
    man = cat.Listing(cat.manifest(cat.list_files(spark, raw_dir, cfg.sources), cfg.sources))
    cat.validate(man)
    return man


def load_inputs(spark: SparkSession, raw_dir: str, man, cfg: Config) -> Inputs:
    """Shards with ``event_order``, metadata, vectors."""
    c = cfg.columns
    log = sh.with_row_index(sh.scan(spark, cat.paths(man, "interactions")), raw_dir)
    items = sh.scan_meta(spark, cat.paths(man, "items"), [c.item_id, c.duration, c.author_id])
    users = sh.scan_meta(spark, cat.paths(man, "users"), [c.user_id, *c.user_static])
    return Inputs(log, items, users, load_vectors(spark, man, cfg), man)


def load_vectors(spark: SparkSession, man, cfg: Config) -> DataFrame | None:
    """The vectors alone; None without them or when they are switched off."""
    if not cfg.features.use_embeddings:
        return None
    return emb.load_vectors(spark, cat.paths(man, "embeddings"), cat.paths(man, "items"),
                            cfg.columns.item_id, cfg.columns.embedding)


def _read(spark: SparkSession, path: str, maker: str, reader: str = "parquet") -> DataFrame:
    """A product of an earlier stage; a clear error when that stage has not run."""
    try:
        return getattr(spark.read, reader)(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"{path} is missing: run the stage {maker!r} first") from e
        raise


def load_manifest(spark: SparkSession, out_dir: str) -> "cat.Listing":
    """The manifest that ``prepare`` wrote."""
    return cat.Listing(_read(spark, f"{out_dir}/manifest", "prepare"))


def load_bounds(spark: SparkSession, out_dir: str) -> ft.Bounds:
    row = _read(spark, f"{out_dir}/reports/bounds", "features", "json").first()
    return ft.Bounds(row["train_end"], row["val_end"])


def load_meta(spark: SparkSession, out_dir: str) -> ds.DatasetMeta:
    row = _read(spark, f"{out_dir}/reports/dataset_meta", "dataset", "json").first()
    return ds.DatasetMeta(**json.loads(row["meta"]))


def run_prepare(spark, raw_dir, out_dir, cfg, res) -> dict:
    found = cat.manifest(cat.list_files(spark, raw_dir, cfg.sources), cfg.sources)
    sinks.write_table(found.coalesce(1), f"{out_dir}/manifest")
    man = load_manifest(spark, out_dir)
    cat.validate(man)
    return {"n_shards": len(man.shards("interactions")), "n_files": len(man.paths("interactions"))}


def run_preprocess(spark, raw_dir, out_dir, cfg, res) -> dict:
    man = load_manifest(spark, out_dir)
    inp = load_inputs(spark, raw_dir, man, cfg)
    path = f"{out_dir}/interactions"
    inter = cl.preprocess(inp.log, inp.items, inp.users, cfg)
    seen = Observation()
    parts = _parts(man, sh.scan(spark, cat.paths(man, "interactions")))
    sinks.write_interactions(inter, path, parts, cfg.scale.sort_interactions_globally, seen)
    # Rows and means come from the write; the exact key counts read two columns of it.
    stats = seen.get | spark.read.parquet(path).agg(*cl.key_counts(cfg)).first().asDict()
    res.stats = {k: float(v) if v is not None else None for k, v in stats.items()}
    kinds = ", ".join(f"{k} {'long' if k.startswith('n_') else 'double'}" for k in stats)
    sinks.write_json_row(spark.createDataFrame([tuple(stats.values())], kinds), f"{out_dir}/reports/stats")
    return res.stats


def run_features(spark, raw_dir, out_dir, cfg, res) -> dict:
    inter = _read(spark, f"{out_dir}/interactions", "preprocess")
    res.bounds = ft.split_bounds(inter, cfg)
    sinks.write_json_row(ft.bounds_frame(spark, res.bounds), f"{out_dir}/reports/bounds")
    feats = ft.build_aggregates(inter, res.bounds, cfg)
    try:
        for name in TABLES:
            sinks.write_table(getattr(feats, name), f"{out_dir}/features/{name}")
    finally:
        feats.release()
    return {f"rows_{name}": spark.read.parquet(f"{out_dir}/features/{name}").count() for name in TABLES}


def run_dataset(spark, raw_dir, out_dir, cfg, res) -> dict:
    man = load_manifest(spark, out_dir)
    inter = _read(spark, f"{out_dir}/interactions", "preprocess")
    res.bounds = load_bounds(spark, out_dir)
    feats = ft.FeatureTables(*[_read(spark, f"{out_dir}/features/{n}", "features") for n in TABLES])
    parts, seen = _parts(man, inter), Observation()
    dset, meta = ds.assemble(inter, feats, res.bounds, cfg, load_vectors(spark, man, cfg), layout=True,
                             num_partitions=parts, written=True)
    sinks.write_grouped_splits(dset, cfg, f"{out_dir}/dataset", parts, seen)
    res.sizes = {split: n for split, n in seen.get.items() if n}
    meta.sizes = dict(res.sizes)
    res.meta = meta
    sinks.write_json_row(spark.createDataFrame([(sinks.meta_json(meta),)], "meta string"),
                         f"{out_dir}/reports/dataset_meta")
    return {f"rows_{k}": v for k, v in res.sizes.items()} | {"emb_built": float(EMB_COS in meta.num_features)}


def run_train(spark, raw_dir, out_dir, cfg, res) -> dict:
    from ..operators import ranker as rkr

    data = _read(spark, f"{out_dir}/dataset", "dataset")
    res.meta = load_meta(spark, out_dir)
    if cfg.model.max_train_rows:
        train = ds.head_whole_groups(data.where(F.col(SPLIT) == "train"), cfg.model.max_train_rows, cfg)
        data = train.unionByName(data.where(F.col(SPLIT) != "train"))
    fit = rkr.fit_and_evaluate(data, res.meta, cfg, curve=True)
    res.metrics = fit.metrics
    rows = [(sp, k, float(v)) for sp, m in fit.metrics.items() for k, v in m.items()]
    sinks.write_json_row(spark.createDataFrame(rows, "split string, name string, value double"),
                         f"{out_dir}/reports/offline_metrics")
    if fit.curve:
        names = [k for k in fit.curve[0] if k != "iteration"]
        points = [(r["iteration"], *(float(r[k]) for k in names)) for r in fit.curve]
        schema = ", ".join(["iteration int", *[f"{k} double" for k in names]])
        sinks.write_json_row(spark.createDataFrame(points, schema), f"{out_dir}/reports/training_curve")
    rkr.save(fit.model, f"{out_dir}/model")
    fit.importances.coalesce(1).write.mode("overwrite").option("header", True).csv(
        f"{out_dir}/reports/feature_importance")
    flat = {f"{sp}/{k}": v for sp, m in fit.metrics.items() for k, v in m.items()}
    if fit.best_iteration is not None:
        flat["best_iteration"] = fit.best_iteration
    return flat


TABLES = ("user", "item", "author", "ua")
RUNNERS = {"prepare": run_prepare, "preprocess": run_preprocess, "features": run_features,
           "dataset": run_dataset, "train": run_train}


def _parts(man, table: DataFrame) -> int:
    """Partitions of a sorted sink by the rows of ``table`` (counted from its footers)."""
    return sinks.sorted_partitions(cat.total_bytes(man, "interactions"), table.count())


def run(spark: SparkSession, raw_dir: str, out_dir: str, cfg: Config = Config(),
        stages=STAGES) -> RunResult:
    """Run the named stages in order. Each reads what earlier stages wrote under
    OUT_DIR, in this run or another, and fails when that is missing."""
    unknown = [s for s in stages if s not in STAGES]
    if unknown:
        raise ValueError(f"unknown stages: {unknown}")
    res = RunResult()
    run_id = uuid.uuid4().hex[:12]
    for name in (s for s in STAGES if s in stages):
        t = time.time()
        with releasing():  # what the stage persisted goes when its product is written
            values = RUNNERS[name](spark, raw_dir, out_dir, cfg, res)
        _track(spark, out_dir, run_id, name, values)
        res.seconds[name] = round(time.time() - t, 3)
    return res


def _track(spark: SparkSession, out_dir: str, run_id: str, stage: str, values: dict) -> None:
    """Tracking scalars appended to one metrics table."""
    vals = {k: v for k, v in values.items() if isinstance(v, (int, float)) and v is not None}
    if vals:
        sinks.append_metrics(sinks.metrics_frame(spark, run_id, stage, vals),
                             f"{out_dir}/reports/tracking")


def read_config(spark: SparkSession, path: str | None, overrides: list[str]) -> Config:
    """Settings from a JSON file (any path that Spark reads) and SECTION.NAME=JSON pairs."""
    values: dict = {}
    if path:
        values = json.loads(spark.read.text(path, wholetext=True).first()[0])
    for item in overrides:
        key, eq, raw = item.partition("=")
        section, dot, name = key.partition(".")
        if not eq or not dot:
            raise ValueError(f"not SECTION.NAME=JSON: {item}")
        values.setdefault(section, {})[name] = json.loads(raw)
    return Config.from_dict(values)


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("raw_dir")
    ap.add_argument("out_dir")
    ap.add_argument("--stages", nargs="*", default=list(STAGES))
    ap.add_argument("--config", help="JSON file of nested settings (see Config)")
    ap.add_argument("--set", nargs="*", default=[], metavar="SECTION.NAME=JSON",
                    help="settings that override the file's")
    a = ap.parse_args(argv)
    unknown = [s for s in a.stages if s not in STAGES]
    if unknown:
        raise SystemExit(f"unknown stages: {unknown}")
    spark = SparkSession.builder.getOrCreate()
    r = run(spark, a.raw_dir, a.out_dir, read_config(spark, a.config, a.set), tuple(a.stages))
    print(json.dumps({"stats": r.stats, "sizes": r.sizes, "metrics": r.metrics,
                      "seconds": r.seconds}, default=str))


if __name__ == "__main__":
    main()

