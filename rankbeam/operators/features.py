"""Features stage: A3 split bounds, P13 train window, A4-A8 aggregates, P12, A11.

All aggregates are computed on the train window only (``event_order <
train_end``); Spark runs them as partial + final hash aggregates, so a hot
user/item/author costs one partial row per task before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EVENT_ORDER, LABEL, SPLIT, WATCH_RATIO, Config
from .quantile import exact_quantiles


@dataclass(frozen=True)
class Bounds:
    train_end: int
    val_end: int


def split_bounds(inter: DataFrame, cfg: Config) -> Bounds:
    """A3: nearest-rank quantiles of ``event_order`` (an action, two ints)."""
    s = cfg.split
    te, ve = exact_quantiles(inter, EVENT_ORDER, [s.train_frac, s.train_frac + s.val_frac])
    if te is None:
        raise ValueError("empty interactions table: no split bounds")
    return Bounds(int(te), int(ve))


def bounds_frame(spark, b: Bounds) -> DataFrame:
    """The two split bounds as a one-row frame (a report sink input)."""
    return spark.createDataFrame([(b.train_end, b.val_end)], "train_end long, val_end long")


def train_window(inter: DataFrame, b: Bounds) -> DataFrame:
    """Events strictly before ``train_end`` (pushed to the scan)."""
    return inter.where(F.col(EVENT_ORDER) < F.lit(b.train_end))


def split_col(b: Bounds) -> Column:
    """Train < train_end <= val < val_end <= test."""
    eo = F.col(EVENT_ORDER)
    return (F.when(eo < F.lit(b.train_end), F.lit("train"))
            .when(eo < F.lit(b.val_end), F.lit("val"))
            .otherwise(F.lit("test"))).alias(SPLIT)


def split_predicate(b: Bounds, splits) -> Column:
    """Rows of the named splits as a range on ``event_order``.

    Unlike a filter on the derived ``split`` label, this reaches the Parquet
    scan (row-group / file min-max skipping on the sorted interactions).
    """
    eo = F.col(EVENT_ORDER)
    parts = {"train": eo < F.lit(b.train_end),
             "val": (eo >= F.lit(b.train_end)) & (eo < F.lit(b.val_end)),
             "test": eo >= F.lit(b.val_end)}
    cond = None
    for name in ([splits] if isinstance(splits, str) else list(splits)):
        cond = parts[name] if cond is None else cond | parts[name]
    return cond


def temporal_split(df: DataFrame, b: Bounds) -> DataFrame:
    """Add the ``split`` label column."""
    return df.withColumn(SPLIT, split_col(b))


def split_sizes(split_df: DataFrame) -> DataFrame:
    """Rows per split."""
    return split_df.groupBy(SPLIT).agg(F.count(F.lit(1)).alias("n_rows"))


def rate_cols(feedback, prefix: str) -> list[Column]:
    """Mean of each feedback flag as ``{prefix}_{flag}_rate``."""
    return [F.avg(F.col(f).cast("double")).alias(f"{prefix}_{f}_rate") for f in feedback]


def n_unique(col: str) -> Column:
    """Distinct count that counts null as one more value (as the reference)."""
    return (F.count_distinct(F.col(col))
            + F.max(F.col(col).isNull().cast("int"))).cast("bigint")


def _mean(col: str) -> Column:
    return F.avg(F.col(col).cast("double"))


@dataclass
class FeatureTables:
    user: DataFrame
    item: DataFrame
    author: DataFrame
    ua: DataFrame
    partials: tuple = ()

    def release(self) -> None:
        """Drop the persisted pair partials once the tables are written."""
        for p in self.partials:
            p.unpersist()


def _pair_partials(train: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Per key pair: row count and sums (partial + final hash aggregate)."""
    return train.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.col(src).cast("double")).alias(dst) for dst, src in sums.items()],
    )


def build_aggregates(inter: DataFrame, b: Bounds, cfg: Config) -> FeatureTables:
    """A4-A8 from two scans of the train window instead of four.

    Every measure is a count or a mean of a non-null column, so the tables
    roll up from partial sums: (user, author) partials give the user x author
    table and, summed per user, the user table (its distinct author count is
    the number of partial rows, null author included, as in ``n_unique``);
    (author, item) partials give the author and item tables the same way.
    """
    c = cfg.columns
    train = train_window(inter, b)
    fb = list(c.feedback)
    flag_sums = {f"_s_{f}": f for f in fb}
    # Persisted: each partial feeds two tables written by separate actions.
    # They are sized by distinct pairs, far below the event count.
    ua_p = _pair_partials(train, [c.user_id, c.author_id],
                          {"_s_wr": WATCH_RATIO, "_s_label": LABEL, "_s_ts": c.timespent,
                           "_s_dur": c.duration, **flag_sums}).persist(StorageLevel.MEMORY_AND_DISK)
    ai_p = _pair_partials(train, [c.author_id, c.item_id],
                          {"_s_wr": WATCH_RATIO, "_s_label": LABEL, **flag_sums}
                          ).persist(StorageLevel.MEMORY_AND_DISK)

    def ratio(num: str, alias: str) -> Column:
        return (F.sum(num) / F.sum("_n")).alias(alias)

    ua = ua_p.select(c.user_id, c.author_id, F.col("_n").alias("ua_n_events"),
                     (F.col("_s_wr") / F.col("_n")).alias("ua_mean_watch_ratio"),
                     (F.col("_s_label") / F.col("_n")).alias("ua_mean_label"))
    user = ua_p.groupBy(c.user_id).agg(
        F.sum("_n").alias("user_n_events"),
        ratio("_s_wr", "user_mean_watch_ratio"), ratio("_s_ts", "user_mean_timespent"),
        ratio("_s_dur", "user_mean_duration"),
        F.count(F.lit(1)).alias("user_n_authors"),
        *[ratio(f"_s_{f}", f"user_{f}_rate") for f in fb],
    )
    item = ai_p.groupBy(c.item_id).agg(
        F.sum("_n").alias("item_n_views"),
        ratio("_s_wr", "item_mean_watch_ratio"), ratio("_s_label", "item_mean_label"),
        *[ratio(f"_s_{f}", f"item_{f}_rate") for f in fb],
    )
    author = ai_p.groupBy(c.author_id).agg(
        F.sum("_n").alias("author_n_views"),
        F.count(F.lit(1)).alias("author_n_items"),
        ratio("_s_wr", "author_mean_watch_ratio"),
        *[ratio(f"_s_{f}", f"author_{f}_rate") for f in fb],
    )
    return FeatureTables(user=user, item=item, author=author, ua=ua, partials=(ua_p, ai_p))
