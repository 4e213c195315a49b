"""A3: exact nearest-rank quantiles of an integer column, no global sort.

The value at 0-based rank ``r = round_half_up((n - 1) * q)`` is found by
histogram refinement: each round counts rows per bucket of a value range, keeps
the bucket holding rank ``r`` and narrows the range to it, until buckets are one
value wide. All targets share a round: their ranges are equal or disjoint, so a
row belongs to at most one of them, and one partially aggregated scan counts
every range. The range filter is pushed to the scan. ``percentile_disc`` would
instead gather all values of the column into one aggregation buffer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nearest_rank(n: int, q: float) -> int:
    """0-based rank of quantile ``q`` among ``n`` values: round half up of (n - 1) q."""
    return int(math.floor((n - 1) * q + 0.5))


def histogram(x: DataFrame, ranges: list[tuple[int, int]], fanout: int) -> DataFrame:
    """Rows of ``x.v`` per (range number, bucket of that range): one scan for all ranges."""
    inside = [(F.col("v") >= lo) & (F.col("v") <= hi) for lo, hi in ranges]
    tag: Column | None = None
    bucket: Column | None = None
    for i, (lo, hi) in enumerate(ranges):
        b = F.floor((F.col("v") - F.lit(lo)) / F.lit(_width(lo, hi, fanout))).cast("long")
        tag = F.when(inside[i], F.lit(i)) if tag is None else tag.when(inside[i], F.lit(i))
        bucket = F.when(inside[i], b) if bucket is None else bucket.when(inside[i], b)
    some = inside[0]
    for cond in inside[1:]:
        some = some | cond
    return x.where(some).groupBy(tag.alias("t"), bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))


def _width(lo: int, hi: int, fanout: int) -> int:
    return max(1, -(-(hi - lo + 1) // fanout))


def exact_ranks(df: DataFrame, col: str, ranks, fanout: int = 4096) -> list[int | None]:
    """Values of integer column ``col`` at 0-based ranks; ``ranks`` is a list or a function of
    the number of non-null values. None for every rank of an empty column."""
    x = df.select(F.col(col).cast("long").alias("v")).where(F.col("v").isNotNull())
    stats = x.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"),
                  F.max("v").alias("hi")).first()
    n = int(stats["n"])
    wanted = ranks(n) if callable(ranks) else ranks
    if n == 0:
        return [None for _ in wanted]
    # (target, its range, rank inside the range)
    state = [(j, (int(stats["lo"]), int(stats["hi"])), r) for j, r in enumerate(wanted)]
    out: list[int | None] = [None for _ in wanted]
    while state:
        ranges = sorted({span for _, span, _ in state})
        counts: dict[int, list] = {}
        for row in histogram(x, ranges, fanout).collect():
            counts.setdefault(row["t"], []).append((row["b"], row["n"]))
        narrowed = []
        for j, (lo, hi), r in state:
            width = _width(lo, hi, fanout)
            seen, chosen = 0, None
            for b, c in sorted(counts.get(ranges.index((lo, hi)), [])):
                if seen + c > r:
                    chosen = b
                    break
                seen += c
            if chosen is None:
                raise RuntimeError("rank outside the histogram")
            low = lo + chosen * width
            if width == 1:
                out[j] = low
            else:
                narrowed.append((j, (low, min(hi, low + width - 1)), r - seen))
        state = narrowed
    return out


def exact_quantiles(df: DataFrame, col: str, qs: list[float], fanout: int = 4096) -> list[int | None]:
    """Values of integer column ``col`` at nearest-rank quantiles ``qs``."""
    return exact_ranks(df, col, lambda n: [nearest_rank(n, q) for q in qs], fanout)
