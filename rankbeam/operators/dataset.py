"""Dataset stage: J4, J5 (fused), P7-P12, A11, O2, O4.

One plan joins the feature tables to the events, derives ``dur_diff``,
normalises types and tags the split; writing it partitioned by ``split``
replaces the reference's three executions of the same join plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EVENT_ORDER, LABEL, SPLIT, Config
from ..functions import columns as fc
from . import vectors as vx
from .features import Bounds, FeatureTables, split_col
from .joins import sized_broadcast, skew_join
from .ordering import cut_hot_groups
from .quantile import exact_ranks


@dataclass
class DatasetMeta:
    label: str
    group: str
    item_id: str
    event_order: str
    num_features: list[str]
    cat_features: list[str]
    split_bounds: dict = field(default_factory=dict)
    sizes: dict = field(default_factory=dict)


@dataclass
class JoinPlan:
    """Sized feature tables and the join strategy chosen from their counts."""

    item: DataFrame
    author: DataFrame
    user: DataFrame
    ua: DataFrame
    small_users: bool
    all_broadcast: bool
    unit: DataFrame | None = None
    dim: int | None = None


def plan_joins(feats: FeatureTables, cfg: Config, profiles: DataFrame | None = None,
               unit: DataFrame | None = None, dim: int | None = None, written: bool = False) -> JoinPlan:
    """Count each dimension once and decide broadcast vs shuffle per table. ``written``
    feature tables are counted from their files and need not be persisted."""
    c, sc = cfg.columns, cfg.scale
    keep = not written
    user_tbl = feats.user
    if profiles is not None:
        user_tbl = user_tbl.join(profiles.select(c.user_id, vx.PROFILE), c.user_id, "full")
    user_tbl = sized_broadcast(user_tbl, sc, dim or 64, persist=keep or profiles is not None)
    item = sized_broadcast(feats.item, sc, persist=keep)
    author = sized_broadcast(feats.author, sc, persist=keep)
    small_users = _is_broadcast(user_tbl)
    ua = sized_broadcast(feats.ua, sc, persist=keep) if small_users else feats.ua
    if unit is not None:
        unit = vx.sized_vectors(unit, cfg, dim)
    all_bc = (small_users and _is_broadcast(ua) and _is_broadcast(item) and _is_broadcast(author)
              and (unit is None or _is_broadcast(unit)))
    return JoinPlan(item, author, user_tbl, ua, small_users, all_bc, unit, dim)


def apply_joins(base: DataFrame, plan: JoinPlan, cfg: Config) -> DataFrame:
    """J4 (+ profile and V1 when vectors are planned); cold rows keep nulls.

    Item and author tables are broadcast when their counted rows and
    estimated bytes are within the ``scale`` limits. The user-keyed tables
    take one of two plans:

    * small (user table within the bound): broadcast user features and
      profiles; the (user, author) table is broadcast or shuffle-joined;
    * large: build one table keyed by the distinct (user, author) pairs of the
      log carrying user features, (user, author) features and the profile,
      and join the events to it once. That is a single shuffle of the event
      table instead of three.

    Shuffle joins of the events deal hot keys (measured; null authors are one of
    them) over several tasks (``joins.skew_join``).
    """
    c = cfg.columns

    def attach(df, dim, keys, null_safe=()):
        if _is_broadcast(dim):
            return df.join(dim, keys, "left")
        return skew_join(df, dim, keys, EVENT_ORDER, null_safe, cfg.scale.hot_key_rows)

    df = attach(attach(base, plan.item, [c.item_id]), plan.author, [c.author_id])
    if plan.small_users:
        df = attach(df.join(plan.user, c.user_id, "left"), plan.ua, [c.user_id, c.author_id])
    else:
        pairs = base.select(c.user_id, c.author_id).distinct()
        keyed = (pairs.join(plan.ua, [c.user_id, c.author_id], "left")
                 .join(plan.user, c.user_id, "left"))
        df = attach(df, keyed, [c.user_id, c.author_id], (c.author_id,))
    if plan.unit is not None:
        df = vx.cosine_from_profile(df, plan.unit, cfg, plan.dim)
    return df


def join_features(inter: DataFrame, feats: FeatureTables, cfg: Config,
                  profiles: DataFrame | None = None) -> DataFrame:
    """J4 as one call: plan the joins from counted sizes, then apply them."""
    return apply_joins(inter, plan_joins(feats, cfg, profiles), cfg)


def _is_broadcast(df: DataFrame) -> bool:
    """True when ``bounded_broadcast`` chose the broadcast hint for ``df``."""
    return bool(getattr(df, "_rb_broadcast", False))


def dur_diff(cfg: Config):
    """|duration - user_mean_duration| as float32 (null for cold users)."""
    return F.abs(F.col(cfg.columns.duration).cast("double")
                 - F.col("user_mean_duration")).cast("float").alias("dur_diff")


# The measures that each feature table adds, after its prefix.
TABLE_MEASURES = (
    ("user", ("n_events", "mean_watch_ratio", "mean_timespent", "mean_duration", "n_authors")),
    ("item", ("n_views", "mean_watch_ratio", "mean_label")),
    ("author", ("n_views", "n_items", "mean_watch_ratio")),
    ("ua", ("n_events", "mean_watch_ratio", "mean_label")),
)
#: Tables that also have one rate per feedback flag.
RATED_TABLES = ("user", "item", "author")
#: Raw columns that stand before a table's measures, by their role.
RAW_BEFORE = {"user": lambda c: [x for x in c.user_static if x == "age"],
              "item": lambda c: [c.duration]}


def feature_lists(columns: list[str], cfg: Config, has_emb: bool) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature names, as the tables declare them, that
    are columns of the joined frame."""
    c = cfg.columns
    numeric: list[str] = []
    for prefix, measures in TABLE_MEASURES:
        numeric += RAW_BEFORE.get(prefix, lambda _: [])(c)
        numeric += [f"{prefix}_{m}" for m in measures]
        if prefix in RATED_TABLES:
            numeric += [f"{prefix}_{flag}_rate" for flag in c.feedback]
    numeric.append("dur_diff")
    if has_emb:
        numeric.append("emb_cos")
    categorical = [x for x in c.user_static if x != "age"] + list(c.context)
    here = set(columns)
    return [x for x in numeric if x in here], [x for x in categorical if x in here]


def assemble(inter: DataFrame, feats: FeatureTables, b: Bounds, cfg: Config,
             vectors: DataFrame | None = None, layout: bool = False,
             num_partitions: int | None = None, written: bool = False) -> tuple[DataFrame, DatasetMeta]:
    """J4 + J5 + P7-P12: the model-ready table with a ``split`` column.

    With ``vectors`` the embedding cosine (V1) is computed inline on the event
    rows, which replaces the reference's event-keyed join of a stored table.

    With ``layout`` the result is also in the O2 layout. When every join is a
    broadcast, the narrow interaction rows are range-partitioned *before* the
    joins (broadcast joins keep the stream side's partitioning), so the wide
    40+ column rows are never shuffled and the range sampling pass reads only
    the interaction columns; the rows are then sorted within their partitions
    (no shuffle), which also gives the writer its required ordering. Otherwise
    the joined rows are laid out after the joins.
    """
    c = cfg.columns
    has_emb = vectors is not None and cfg.features.use_embeddings
    prof = unit = dim = None
    if has_emb:
        # Size check at the configured width, then the true width from the
        # persisted (truncated, normalised) table: the vectors are read once.
        unit = vx.sized_vectors(vx.unit_vectors(vectors, cfg, inter), cfg,
                                cfg.features.embedding_dim or 64)
        dim = vx.width_of(unit)
        prof = vx.user_profiles(inter, unit, b.train_end, cfg, dim)
    plan = plan_joins(feats, cfg, prof, unit, dim, written)
    base = inter.withColumn(SPLIT, split_col(b))
    early = layout and plan.all_broadcast
    if early:
        base = range_layout(base, cfg, num_partitions)
    df = apply_joins(base, plan, cfg)
    df = df.withColumn("dur_diff", dur_diff(cfg))
    num, cat = feature_lists(df.columns, cfg, has_emb)
    df = df.select(
        c.user_id, c.item_id, EVENT_ORDER, LABEL,
        *[fc.lenient_float(x) for x in num], *[fc.categorical(x) for x in cat],
        SPLIT,
    )
    if early:
        df = df.sortWithinPartitions(SPLIT, c.user_id, EVENT_ORDER)
    elif layout:
        df = grouped_layout(df, cfg, num_partitions)
    if layout:
        df._rb_layout = True
    meta = DatasetMeta(LABEL, c.user_id, c.item_id, EVENT_ORDER, num, cat,
                       {"train_end": b.train_end, "val_end": b.val_end})
    return df, meta


def range_layout(ds: DataFrame, cfg: Config, num_partitions: int | None = None) -> DataFrame:
    """Range partitions on (split, user, event_order), not yet sorted."""
    keys = [SPLIT, cfg.columns.user_id, EVENT_ORDER]
    return (ds.repartitionByRange(num_partitions, *keys) if num_partitions
            else ds.repartitionByRange(*keys))


def grouped_layout(ds: DataFrame, cfg: Config, num_partitions: int | None = None) -> DataFrame:
    """O2: rows of one user contiguous, in ``event_order``, per split.

    Range partitioning on (split, user, event_order) keeps files in key order;
    a hot user is cut over neighbouring files (no single huge task) and stays
    one contiguous run when files are read in order.
    """
    return range_layout(ds, cfg, num_partitions).sortWithinPartitions(
        SPLIT, cfg.columns.user_id, EVENT_ORDER)


def head_whole_groups(ds: DataFrame, n: int, cfg: Config, piece_rows: int = 100_000) -> DataFrame:
    """First ``n`` rows by (user, event_order); drop the last, maybe cut group.

    A prefix sum without a sort of the rows: rows per user, their sums per ordered piece of
    the users, then the counts of the one piece that holds row ``n`` (at most about
    ``piece_rows`` users come to the driver). The result is a plain filter by the user found.
    """
    u = cfg.columns.user_id
    counts = ds.where(F.col(u).isNotNull()).groupBy(u).agg(F.count(F.lit(1)).alias("_n"))
    cut, pieces = cut_hot_groups(counts, [], [(u, True)], piece_rows)
    left, earlier, here = int(n), 0, cut
    if pieces:
        sums = cut.groupBy(*pieces).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("users")).collect()
        # A piece that was not cut again has null in the later columns.
        sums.sort(key=lambda r: tuple(-1 if r[p] is None else r[p] for p in pieces))
        for r in sums[:-1]:
            if r["n"] >= left:
                break
            left, earlier = left - r["n"], earlier + r["users"]
        else:
            r = sums[-1]
        for p in pieces:
            here = here.where(F.col(p).eqNullSafe(F.lit(r[p])))
    users = sorted((r[u], r["_n"]) for r in here.select(u, "_n").collect())
    if not users:
        return ds.where(F.lit(False))
    at, upto = 0, users[0][1]
    while upto < left and at + 1 < len(users):
        at += 1
        upto += users[at][1]
    last = F.lit(users[at][0])
    if earlier + at > 0:
        return ds.where(F.col(u) < last)
    one = ds.where(F.col(u) == last)
    if upto <= left:
        return one
    end = exact_ranks(one, EVENT_ORDER, [left - 1])[0]
    return one.where(F.col(EVENT_ORDER) <= end)


def load_split(spark, dataset_dir: str, split: str, meta: DatasetMeta, cfg: Config,
               max_rows: int | None = None) -> DataFrame:
    """Features + label + group of one split; stays distributed.

    The split is a partition folder, so only its files are read. With
    ``max_rows`` the first rows by (user, event_order) are kept and the last,
    possibly cut group is dropped (O4).
    """
    df = spark.read.parquet(dataset_dir).where(F.col(SPLIT) == split)
    cols = [meta.group, meta.item_id, meta.event_order, meta.label,
            *meta.num_features, *meta.cat_features]
    df = df.select(*cols)
    if max_rows:
        df = head_whole_groups(df, int(max_rows), cfg)
    return df
