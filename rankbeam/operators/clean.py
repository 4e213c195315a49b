"""Preprocess stage: P1-P6, J1-J3, A1, A2.

Each operator is ``(DataFrame, Config) -> DataFrame`` and stays lazy, so the
whole stage is one Catalyst plan (filters reach the Parquet scan, unused
columns are pruned).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EVENT_ORDER, LABEL, WATCH_RATIO, Config
from ..functions import columns as fc
from .joins import hold, row_bytes, shuffled_if_large


def normalise_feedback(log: DataFrame, cfg: Config) -> DataFrame:
    """P1 + P2: flags -> tinyint with null -> 0, then drop rows with a null id.

    Runs after ``event_order`` is assigned, so dropped rows leave gaps.
    """
    c = cfg.columns
    missing = [x for x in c.feedback if x not in log.columns]
    if missing:
        raise ValueError(f"feedback columns missing from the log: {missing}")
    fb = set(c.feedback)
    cols = [fc.flag(x) if x in fb else F.col(x) for x in log.columns]
    return log.select(*cols).na.drop(subset=[c.user_id, c.item_id])


def enrich(log: DataFrame, items: DataFrame | None, users: DataFrame | None,
           cfg: Config) -> DataFrame:
    """J1 + J2: left joins with item and user metadata (duplicates fan out).

    The dimensions are joined by key; the planner broadcasts them when their
    measured size is small (AQE). Above the ``scale`` limits they are shuffled.
    """
    c = cfg.columns
    if items is not None:
        keep = [x for x in (c.item_id, c.duration, c.author_id) if x in items.columns]
        log = log.join(shuffled_if_large(items.select(*keep), cfg.scale), c.item_id, "left")
    elif c.duration not in log.columns:
        raise ValueError("no item metadata and no duration column in the log")
    if users is not None:
        keep = [x for x in (c.user_id, *c.user_static) if x in users.columns]
        log = log.join(shuffled_if_large(users.select(*keep), cfg.scale), c.user_id, "left")
    return log


def sample_users(df: DataFrame, cfg: Config) -> DataFrame:
    """Keep users whose md5 bucket of (user_id|seed) is below frac*10000."""
    frac = cfg.sample.user_fraction
    if not frac:
        return df
    bucket = fc.portable_hash_bucket(F.col(cfg.columns.user_id), cfg.sample.seed)
    return df.where(bucket < F.lit(int(float(frac) * 10_000)))


def clean(df: DataFrame, cfg: Config) -> DataFrame:
    """Valid timespent in [0, max] and a positive, non-NaN duration."""
    c = cfg.columns
    t, d = F.col(c.timespent), F.col(c.duration)
    return df.where(
        t.isNotNull() & (t >= 0) & (t <= F.lit(cfg.cleaning.max_timespent_sec))
        & d.isNotNull() & ~F.isnan(d.cast("double")) & (d > 0)
    )


def add_watch_ratio(df: DataFrame, cfg: Config) -> DataFrame:
    """P4."""
    return df.withColumn(WATCH_RATIO, fc.watch_ratio(cfg))


def activity_filter(df: DataFrame, cfg: Config, counted: DataFrame | None = None) -> DataFrame:
    """A1 + J3: keep users/items with enough events, both counted on ``counted`` (default
    ``df``), which must have the same rows and may have fewer columns or joins.

    One round, not a fixpoint: a kept user may end below the minimum after the
    item filter. Both counts come from one scan with ``GROUPING SETS ((user),
    (item))``, aggregated within the tasks first (a hot key costs one partial row
    per task). The surviving key sets are counted once; each is broadcast only
    when its rows and bytes (rows x key width) are within the ``scale`` limits,
    otherwise the semi join shuffles and AQE splits a skewed key's partition.
    """
    c, cl = cfg.columns, cfg.cleaning
    lim = cfg.scale.broadcast_max_rows
    u, i = F.col(c.user_id), F.col(c.item_id)
    counts = (counted if counted is not None else df).groupingSets([[u], [i]], u, i).agg(
        F.grouping(c.user_id).alias("_kind"), F.count(F.lit(1)).alias("_n"))
    least = F.when(F.col("_kind") == 0, cl.min_user_interactions).otherwise(cl.min_item_interactions)
    keep = hold(counts.where(F.col("_n") >= least))
    sizes = {r["_kind"]: r["n"] for r in keep.groupBy("_kind").agg(F.count(F.lit(1)).alias("n")).collect()}

    def side(kind, name):
        t = keep.where(F.col("_kind") == kind).select(name)
        n = sizes.get(kind, 0)
        small = n <= lim and n * row_bytes(t.schema) <= cfg.scale.broadcast_max_bytes
        return F.broadcast(t) if small else t.hint("merge")

    out = df.join(side(0, c.user_id), c.user_id, "left_semi")
    return out.join(side(1, c.item_id), c.item_id, "left_semi")


def unique_key(meta: DataFrame, key: str) -> bool:
    """No two rows share a non-null key: a left join with ``meta`` keeps every row once."""
    return meta.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty()


def add_label(df: DataFrame, cfg: Config) -> DataFrame:
    """P5."""
    return df.withColumn(LABEL, fc.label_expr(cfg))


def preprocess(log: DataFrame, items: DataFrame | None, users: DataFrame | None,
               cfg: Config) -> DataFrame:
    """Whole preprocess stage: the interactions table, lazily.

    When no two user rows share an id, the user columns neither add nor drop rows, so the
    activity counts are taken before they are joined, and only kept rows are joined.
    """
    late = users is not None and unique_key(users, cfg.columns.user_id)
    df = normalise_feedback(log, cfg)
    df = enrich(df, items, None if late else users, cfg)
    df = sample_users(df, cfg)
    df = clean(df, cfg)
    df = add_watch_ratio(df, cfg)
    df = activity_filter(df, cfg)
    df = add_label(df, cfg)
    if not late:
        return df
    keep = [x for x in (cfg.columns.user_id, *cfg.columns.user_static) if x in users.columns]
    made = [c for c in (WATCH_RATIO, LABEL) if c in df.columns]
    joined = df.join(shuffled_if_large(users.select(*keep), cfg.scale), cfg.columns.user_id, "left")
    return joined.select(*[c for c in joined.columns if c not in made], *made)


def row_stats() -> list:
    """The part of A2 that one pass over the rows gives without a shuffle."""
    return [F.count(F.lit(1)).alias("n_rows"),
            F.avg(F.col(LABEL).cast("double")).alias("label_mean"),
            F.avg((F.col(LABEL) >= fc.float_lit(1.0)).cast("double")).alias("label_pos_share"),
            F.avg(F.col(WATCH_RATIO).cast("double")).alias("watch_ratio_mean")]


def key_counts(cfg: Config) -> list:
    """The part of A2 that counts users and items exactly."""
    c = cfg.columns
    return [F.count_distinct(c.user_id).alias("n_users"), F.count_distinct(c.item_id).alias("n_items")]


def stage_stats(df: DataFrame, cfg: Config) -> DataFrame:
    """A2: one-row statistics of the interactions table (exact distincts)."""
    return df.agg(*row_stats(), *key_counts(cfg))


def sort_by_order(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """O1: range-partition and sort by ``event_order`` before the sink.

    Files then carry disjoint ``event_order`` ranges, so the later train-window
    and split filters skip whole files/row groups by min/max statistics.
    """
    ranged = (df.repartitionByRange(num_partitions, EVENT_ORDER) if num_partitions
              else df.repartitionByRange(EVENT_ORDER))
    return ranged.sortWithinPartitions(EVENT_ORDER)
