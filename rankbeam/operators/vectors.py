"""Embedding feature: P15, P16, J6, A10, V1, J7.

Vectors stay ``array<double>`` columns; math is Spark higher-order functions
(``zip_with`` / ``aggregate`` / ``transform``), so nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EVENT_ORDER, LABEL, Config
from ..functions import columns as fc
from ..functions import vectors as fv
from .joins import bounded_broadcast
from .ordering import ordered_index

VEC = "vec"
PROFILE = "profile"
EMB_COS = "emb_cos"


def vector_width(vectors: DataFrame, cfg: Config) -> int:
    """Width after truncation: min(stored width, ``embedding_dim``).

    One small action over the vector table (bounded by the item count).
    """
    row = vectors.agg(F.max(F.size(cfg.columns.embedding)).alias("w")).first()
    w = int(row["w"] or 0)
    dim = cfg.features.embedding_dim
    return min(w, int(dim)) if dim else w


def width_of(unit: DataFrame) -> int:
    """Width of an already truncated vector table (one small aggregate)."""
    row = unit.agg(F.max(F.size(VEC)).alias("w")).first()
    return int(row["w"] or 0)


def unit_vectors(vectors: DataFrame, cfg: Config, log: DataFrame | None = None) -> DataFrame:
    """P15 + P16 (+ J6 when ``log`` is given): (item_id, vec) truncated, L2-normalised.

    Duplicate item ids keep one vector by a fixed rule (the smallest array),
    so repeated runs agree.
    """
    c = cfg.columns
    v = vectors.select(c.item_id, F.col(c.embedding).alias(VEC)).where(F.col(VEC).isNotNull())
    if log is not None:
        v = v.join(log.select(c.item_id).distinct(), c.item_id, "left_semi")
    v = v.groupBy(c.item_id).agg(F.min(VEC).alias(VEC))
    v = v.select(c.item_id, fv.l2_normalize(fv.truncate(F.col(VEC), cfg.features.embedding_dim)).alias(VEC))
    return v


def sized_vectors(vecs: DataFrame, cfg: Config, dim: int) -> DataFrame:
    """Broadcast a vector table only under the cell bound (rows x width).

    The decision is made once per frame: a frame already counted (and
    persisted) keeps its hint, so callers can share one normalised table.
    """
    if getattr(vecs, "_rb_sized", False):
        return vecs
    out = bounded_broadcast(vecs, cfg.scale.broadcast_max_vector_cells // max(dim, 1),
                            max_bytes=cfg.scale.broadcast_max_bytes, array_len=max(dim, 1))
    out._rb_sized = True
    return out


def user_profiles(inter: DataFrame, unit: DataFrame, train_end: int, cfg: Config,
                  dim: int) -> DataFrame:
    """A10: per user, mean of unit vectors of train positives, L2-normalised.

    One vote per event (repeats count). Events are first reduced to
    (user, item, votes) with a partial aggregate, so the vector join sees at
    most one row per distinct pair; the per-user sums are ``dim`` plain sum
    aggregates (partial + final, safe for a hot user).
    """
    c = cfg.columns
    pos = inter.where((F.col(EVENT_ORDER) < F.lit(train_end))
                      & (F.col(LABEL) >= fc.float_lit(cfg.features.profile_pos_label)))
    pairs = pos.groupBy(c.user_id, c.item_id).agg(F.count(F.lit(1)).alias("votes"))
    j = pairs.join(sized_vectors(unit, cfg, dim), c.item_id, "inner")
    sums = [F.sum(F.col("votes") * F.try_element_at(VEC, F.lit(i + 1))).alias(f"s{i}")
            for i in range(dim)]
    agg = j.groupBy(c.user_id).agg(F.sum("votes").alias("n_votes"), *sums)
    mean = F.array(*[F.col(f"s{i}") / F.col("n_votes") for i in range(dim)])
    return agg.select(c.user_id, "n_votes", fv.l2_normalize(mean).alias(PROFILE))


def attach_cosine(df: DataFrame, profiles: DataFrame, unit: DataFrame, cfg: Config,
                  dim: int) -> DataFrame:
    """V1: ``emb_cos`` = dot(profile, item vector) per row; NaN when either is missing.

    Computed inline on the event rows (no event-keyed join back). Both
    dimensions are joined by their own key; each is broadcast only when its
    counted size is within the configured bound.
    """
    c = cfg.columns
    prof = sized_vectors(profiles.select(c.user_id, PROFILE), cfg, dim)
    j = df.join(prof, c.user_id, "left").join(sized_vectors(unit, cfg, dim), c.item_id, "left")
    cos = F.when(F.col(PROFILE).isNotNull() & F.col(VEC).isNotNull(),
                 fv.dot_n(F.col(PROFILE), F.col(VEC), dim)).otherwise(F.lit(float("nan")))
    return j.withColumn(EMB_COS, cos.cast("float")).drop(PROFILE, VEC)


def attach_stored_cosine(df: DataFrame, cos_table: DataFrame | None) -> DataFrame:
    """Left join of a stored (event_order, emb_cos) table; no-op without one.

    The fused path (``attach_cosine``) avoids this event-keyed shuffle; this
    form serves a cosine table written by an earlier run (S13).
    """
    if cos_table is None:
        return df
    return df.join(cos_table.select(EVENT_ORDER, EMB_COS), EVENT_ORDER, "left")


def cosine_from_profile(df: DataFrame, unit: DataFrame, cfg: Config, dim: int) -> DataFrame:
    """V1 on rows that already carry the ``profile`` column (joined by user)."""
    c = cfg.columns
    j = df.join(sized_vectors(unit, cfg, dim), c.item_id, "left")
    cos = F.when(F.col(PROFILE).isNotNull() & F.col(VEC).isNotNull(),
                 fv.dot_n(F.col(PROFILE), F.col(VEC), dim)).otherwise(F.lit(float("nan")))
    return j.withColumn(EMB_COS, cos.cast("float")).drop(PROFILE, VEC)


def profile_coverage(inter: DataFrame, profiles: DataFrame, cfg: Config) -> DataFrame:
    """Users with a profile among all users of the log."""
    c = cfg.columns
    users = inter.select(c.user_id).distinct()
    j = users.join(profiles.select(c.user_id, F.lit(1).alias("has")), c.user_id, "left")
    return j.agg(F.count("has").alias("n_with_profile"), F.count(F.lit(1)).alias("n_users"))


def id_lookup(sorted_ids: DataFrame, query: DataFrame, id_col: str) -> DataFrame:
    """Position of each query id in the ascending id list, -1 if absent.

    The position is a distributed ordered index (a long list is cut into
    ordered pieces), then a left equi join; no sorted array is gathered
    anywhere.
    """
    idx = ordered_index(sorted_ids.select(id_col).distinct(), [], [(id_col, True)], "idx")
    return (query.join(idx, id_col, "left")
            .withColumn("idx", F.coalesce(F.col("idx"), F.lit(-1).cast("long"))))
