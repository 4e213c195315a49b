"""Invariant checks as Spark queries; each returns rows or counts
that must be empty / zero on a correct pipeline output."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EVENT_ORDER, LABEL, SPLIT, WATCH_RATIO, Config
from ..functions import columns as fc


def leaky_names(cfg: Config) -> set[str]:
    """Columns that are target signals of the current event."""
    c = cfg.columns
    return {c.timespent, WATCH_RATIO, LABEL, *c.feedback}


def group_runs_per_file(written: DataFrame, cfg: Config) -> DataFrame:
    """Per split: rows, broken user runs and order breaks, inside files and across them.

    Reads ``_metadata`` of the written dataset; the window is per file (a file
    is one task's output), ordered by the row position in the file. A user in
    several files is one run only if the user ends each of them but the last and
    begins the next in file order; every other crossing is a broken run.
    """
    u = cfg.columns.user_id
    df = written.select(SPLIT, u, EVENT_ORDER,
                        F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.row_index").alias("_row"))
    w = Window.partitionBy("_file").orderBy("_row")
    prev_u = F.lag(u).over(w)
    prev_eo = F.lag(EVENT_ORDER).over(w)
    df = df.select(SPLIT, u, "_file", "_row",
                   (prev_u.isNull() | (prev_u != F.col(u))).cast("long").alias("_run_start"),
                   ((prev_u == F.col(u)) & (prev_eo > F.col(EVENT_ORDER))).cast("long").alias("_back"))
    per_user = df.groupBy(SPLIT, "_file", u).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_run_start").alias("runs"), F.sum("_back").alias("back"),
        F.min("_row").alias("_from"), F.max("_row").alias("_to"))
    per_file = per_user.groupBy(SPLIT, "_file").agg(
        F.sum("n").alias("n"), F.sum("runs").alias("runs"), F.sum("back").alias("back"), F.min_by(u, "_from").alias("_first"), F.max_by(u, "_to").alias("_last"))
    # one row per file
    files = Window.partitionBy(SPLIT).orderBy("_file")
    per_file = per_file.withColumn("_joined", (F.lead("_first").over(files) == F.col("_last")).cast("long"))
    users = per_user.groupBy(SPLIT).agg(F.count_distinct(u).alias("_all_users"))
    total = per_file.groupBy(SPLIT).agg(
        F.sum("n").alias("n_rows"), F.sum("runs").alias("_runs"),
        F.coalesce(F.sum("_joined"), F.lit(0)).alias("_crossings"), F.sum("back").alias("order_breaks"))
    return total.join(users, SPLIT).select(
        SPLIT, "n_rows", (F.col("_runs") - F.col("_crossings") - F.col("_all_users")).alias("broken_runs"),
        "order_breaks")


def sorted_files(written: DataFrame) -> DataFrame:
    """O1 read back: rows, range of ``event_order``, files that overlap the file before them,
    rows that stand before a smaller one in their file."""
    rows = written.select(EVENT_ORDER, F.col("_metadata.file_path").alias("_file"),
                          F.col("_metadata.row_index").alias("_row"))
    back = F.lag(EVENT_ORDER).over(Window.partitionBy("_file").orderBy("_row")) > F.col(EVENT_ORDER)
    files = rows.withColumn("_back", back.cast("long")).groupBy("_file").agg(
        F.count(F.lit(1)).alias("n"), F.min(EVENT_ORDER).alias("lo"), F.max(EVENT_ORDER).alias("hi"),
        F.coalesce(F.sum("_back"), F.lit(0)).alias("back"))
    # one row per file
    over = F.max("hi").over(Window.orderBy("lo", "_file").rowsBetween(Window.unboundedPreceding, -1)) >= F.col("lo")
    return files.withColumn("over", over.cast("long")).agg(
        F.sum("n").alias("n_rows"), F.min("lo").alias("first"), F.max("hi").alias("last"),
        F.coalesce(F.sum("over"), F.lit(0)).alias("n_overlaps"), F.sum("back").alias("n_unsorted"))


def split_coverage(inter: DataFrame, ds: DataFrame) -> dict:
    """Splits cover all events and are disjoint."""
    total = inter.count()
    per = {r[SPLIT]: r["n"] for r in ds.groupBy(SPLIT).agg(F.count(F.lit(1)).alias("n")).collect()}
    tr = ds.where(F.col(SPLIT) == "train").select(EVENT_ORDER)
    va = ds.where(F.col(SPLIT) == "val").select(EVENT_ORDER)
    te = ds.where(F.col(SPLIT) == "test").select(EVENT_ORDER)
    overlap = tr.intersect(va).count() + tr.intersect(te).count() + va.intersect(te).count()
    return {"total": total, "per_split": per, "overlap": overlap}


def split_bounds_respected(ds: DataFrame, train_end: int, val_end: int) -> DataFrame:
    """Rows whose split label disagrees with the bounds (must be empty)."""
    eo = F.col(EVENT_ORDER)
    bad = (((F.col(SPLIT) == "train") & (eo >= train_end))
           | ((F.col(SPLIT) == "val") & ((eo < train_end) | (eo >= val_end)))
           | ((F.col(SPLIT) == "test") & (eo < val_end)))
    return ds.where(bad)


def leaky_columns(feature_names: list[str], cfg: Config) -> list[str]:
    """Features that are target signals of the current event (must be empty)."""
    leaky = leaky_names(cfg)
    return [c for c in feature_names if c in leaky]


def label_mismatch(inter: DataFrame, cfg: Config) -> DataFrame:
    """Rows whose label differs from the formula, or a dislike with a label."""
    again = fc.label_expr(cfg)
    return inter.where((F.col(LABEL) != again) | ((F.col("dislike") > 0) & (F.col(LABEL) != 0)))


def order_unique(inter: DataFrame) -> bool:
    """``event_order`` has no duplicates."""
    r = inter.agg(F.count(EVENT_ORDER).alias("n"), F.count_distinct(EVENT_ORDER).alias("d")).first()
    return r["n"] == r["d"]


def item_set_mismatch(item_features: DataFrame, train: DataFrame, cfg: Config) -> int:
    """Items in one of (item features, train window) but not the other (must be 0)."""
    k = cfg.columns.item_id
    a = item_features.select(k).join(train.select(k).distinct(), k, "left_anti").count()
    b = train.select(k).distinct().join(item_features.select(k), k, "left_anti").count()
    return a + b


def cosine_out_of_range(cos: DataFrame) -> DataFrame:
    """Non-NaN cosines outside [-1, 1] (must be empty)."""
    c = F.col("emb_cos")
    return cos.where(~F.isnan(c) & ((c < -1.0 - 1e-5) | (c > 1.0 + 1e-5)))


def ratio_out_of_range(inter: DataFrame, cfg: Config) -> DataFrame:
    """Watch ratios outside [0, max_watch_ratio] (must be empty)."""
    r = F.col(WATCH_RATIO)
    return inter.where((r < 0) | (r > F.lit(cfg.cleaning.max_watch_ratio)))


def invariant_counts(inter: DataFrame, ds: DataFrame, meta, train_end: int, val_end: int,
                     cfg: Config) -> DataFrame:
    """One row of violation counts over the whole tables (all must be 0).

    Each count is a distributed aggregate; nothing is collected per row.
    """
    eo = F.col(EVENT_ORDER)
    bad_bounds = (((F.col(SPLIT) == "train") & (eo >= train_end))
                  | ((F.col(SPLIT) == "val") & ((eo < train_end) | (eo >= val_end)))
                  | ((F.col(SPLIT) == "test") & (eo < val_end)))
    null_cat = None
    for c in meta.cat_features:
        cond = F.col(c).isNull()
        null_cat = cond if null_cat is None else null_cat | cond
    ds_counts = ds.agg(
        F.count(F.lit(1)).alias("n_dataset_rows"),
        F.count_distinct(EVENT_ORDER).alias("n_distinct_events"),
        F.sum(bad_bounds.cast("long")).alias("n_bound_violations"),
        F.sum((null_cat if null_cat is not None else F.lit(False)).cast("long")).alias("n_null_categorical"),
    )
    again = fc.label_expr(cfg)
    r = F.col(WATCH_RATIO)
    in_counts = inter.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(((F.col(LABEL) != again) | ((F.col("dislike") > 0) & (F.col(LABEL) != 0)))
              .cast("long")).alias("n_label_mismatch"),
        F.sum(((r < 0) | (r > F.lit(cfg.cleaning.max_watch_ratio))).cast("long")).alias("n_ratio_out_of_range"),
    )
    leaky = len(leaky_columns(list(meta.num_features) + list(meta.cat_features), cfg))
    a, b = ds_counts.first(), in_counts.first()  # one row each
    names = ["n_rows", "n_dataset_rows", "n_distinct_events", "n_bound_violations",
             "n_null_categorical", "n_label_mismatch", "n_ratio_out_of_range", "n_leaky_features"]
    vals = [b["n_rows"], a["n_dataset_rows"], a["n_distinct_events"], a["n_bound_violations"],
            a["n_null_categorical"], b["n_label_mismatch"], b["n_ratio_out_of_range"], leaky]
    row = tuple(int(v or 0) for v in vals)
    return inter.sparkSession.createDataFrame([row], ", ".join(f"{n} long" for n in names))


def duplicate_keys(dim: DataFrame, key: str) -> int:
    """Keys that occur more than once in a dimension (they fan out in J1/J2).

    The fan-out is kept, as in the reference; this reports it. One partially
    aggregated count per key, then a count of keys above one.
    """
    return dim.groupBy(key).count().where(F.col("count") > 1).count()
