"""Column expressions (all JVM-side, codegen'd built-ins)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LABEL, WATCH_RATIO, Config


def clip(c: Column, lo: float | None, hi: float | None) -> Column:
    """``least(greatest(c, lo), hi)``; a missing bound is not applied."""
    if lo is not None:
        c = F.greatest(c, F.lit(lo))
    if hi is not None:
        c = F.least(c, F.lit(hi))
    return c


def flag(name: str) -> Column:
    """Feedback flag as tinyint, null -> 0."""
    return F.coalesce(F.col(name).cast("tinyint"), F.lit(0).cast("tinyint")).alias(name)


def float_lit(x: float) -> Column:
    """A float32 literal, so a float column compares in its own type."""
    return F.lit(x).cast("float")


def watch_ratio(cfg: Config) -> Column:
    """Timespent / duration clipped to [0, max_watch_ratio], float32."""
    c = cfg.columns
    ratio = F.col(c.timespent).cast("double") / F.col(c.duration).cast("double")
    return clip(ratio, 0.0, cfg.cleaning.max_watch_ratio).cast("float").alias(WATCH_RATIO)


def label_expr(cfg: Config) -> Column:
    """P5: weighted graded relevance, clipped, zeroed by a dislike, float32."""
    lbl = cfg.label
    watched = (F.col(WATCH_RATIO) >= float_lit(lbl.watch_ratio_threshold)).cast("double")
    terms = [watched * F.lit(float(lbl.watch_weight))]
    terms += [F.col(f).cast("double") * F.lit(float(w)) for f, w in lbl.weights]
    expr = clip(reduce(lambda a, b: a + b, terms), 0.0, lbl.clip_max)
    if lbl.dislike_zero and "dislike" in cfg.columns.feedback:
        expr = F.when(F.col("dislike") > 0, F.lit(0.0)).otherwise(expr)
    return expr.cast("float").alias(LABEL)


def portable_hash_bucket(col: Column, seed: int, buckets: int = 10_000) -> Column:
    """Deterministic per-value bucket in [0, buckets) from md5(value|seed).

    The first 32 bits of the md5 digest, so any engine with md5 reproduces it.
    """
    digest = F.md5(F.concat(col.cast("string"), F.lit(f"|{seed}")))
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets))


def lenient_float(name: str) -> Column:
    """Numeric feature -> float32, unparsable -> null (ANSI-safe)."""
    return F.expr(f"try_cast(`{name}` AS float)").alias(name)


def categorical(name: str) -> Column:
    """Categorical -> string, null -> 'unknown'."""
    return F.coalesce(F.col(name).cast("string"), F.lit("unknown")).alias(name)


def nan_to_null(c: Column) -> Column:
    """NaN -> null (for comparisons and SQL engines without NaN semantics)."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)
