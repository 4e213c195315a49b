"""Skew-safe position within a group (W1-W3 per-row positions, J7 id index).

A window ``row_number() over (partition by g order by k)`` sorts every group in
one task, so one user holding a third of the log becomes one task. Here groups
with more than ``hot_rows`` rows are first cut into ordered pieces: quantile
cuts of the first order column, of the same column again inside pieces that
are still too large, then of the next column. The window then runs per (group,
piece), and the rows of earlier pieces are added as an offset.

Everything is a DataFrame expression. A piece is a function of the row's own
values and of cuts that the driver holds (their number is bounded by rows /
``hot_rows``), so the windows and the offsets always agree, also when a lost
task is run again; nothing is persisted or written. Without hot groups the
cost is one grouped count over the group columns.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one group that a single task sorts.
HOT_ROWS = 2_000_000
#: Cuts of one piece in one round.
CUTS = 255
_PIECE = "_piece"

#: (column, ascending); nulls come last either way.
Order = list[tuple[str, bool]]


def order_by(order: Order) -> list[Column]:
    return [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in order]


def _rising(df: DataFrame, name: str, up: bool) -> Iterator[Column]:
    """Doubles that, compared one after the other, never fall along the order: of a long
    its upper and lower bits, of a string six bytes after six."""
    t, x = df.schema[name].dataType, F.col(name)
    last = F.lit(float("inf"))
    if isinstance(t, T.StringType):
        for at in itertools.count(1, 6):
            six = F.conv(F.rpad(F.hex(F.substring(F.encode(x, "utf-8"), at, 6)), 12, "0"), 16, 10).cast("double")
            yield F.coalesce(six if up else -six, last)
    elif isinstance(t, (T.LongType, T.TimestampType)):
        n = F.unix_micros(x) if isinstance(t, T.TimestampType) else x
        for part in (F.shiftright(n, 21), n.bitwiseAND(F.lit((1 << 21) - 1))):
            yield F.coalesce(part.cast("double") if up else -part.cast("double"), last)
    elif isinstance(t, (T.NumericType, T.BooleanType, T.DateType)):
        v = F.unix_date(x).cast("double") if isinstance(t, T.DateType) else x.cast("double")
        nan = F.isnan(v)  # sorts above all values
        yield F.coalesce(F.when(nan, last if up else -last).otherwise(v if up else -v), last)
        yield F.when(v.isNull(), 2.0).when(nan, 1.0 if up else 0.0).otherwise(0.0 if up else 1.0)


def _match(left: list[str], right: list[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right, strict=True):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def _too_large(df: DataFrame, keys: list[str], hot_rows: int) -> list:
    """Keys and rows of the pieces above ``hot_rows``; at most rows / ``hot_rows`` of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > hot_rows).collect()


def _local(df: DataFrame, keys: list[str], rows: list[tuple], extra: list[T.StructField]) -> DataFrame:
    """Driver rows as a table whose key columns are called ``_k0``, ``_k1``, ..."""
    fields = [T.StructField(f"_k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    return F.broadcast(df.sparkSession.createDataFrame(rows, T.StructType(fields + extra)))


def cut_hot_groups(df: DataFrame, group_cols: list[str], order: Order,
                   hot_rows: int = HOT_ROWS) -> tuple[DataFrame, list[str]]:
    """``df`` with piece columns (null outside hot groups), and their names. Within a group
    rows of a smaller piece, compared column by column, come earlier in the order."""
    pieces: list[str] = []
    hot = _too_large(df, group_cols, hot_rows)
    for name, up in order:
        for value in _rising(df, name, up):
            while hot:
                cuts = _cuts(df, [*group_cols, *pieces], name, value, hot, hot_rows)
                if not cuts.rows:
                    break
                df = _cut(df, [*group_cols, *pieces], value, cuts.rows, f"{_PIECE}{len(pieces)}")
                pieces.append(f"{_PIECE}{len(pieces)}")
                hot = _too_large(df, [*group_cols, *pieces], hot_rows)
            if not hot:
                return df, pieces
            if cuts.constant:  # the next column decides
                break
        else:  # values that no double tells apart: these pieces stay as they are
            return df, pieces
    return df, pieces


@dataclass
class _Cuts:
    rows: list[tuple]  # the key of a piece and its cuts
    constant: bool  # every piece has one value of the column


def _cuts(df: DataFrame, keys: list[str], name: str, value: Column, hot: list, hot_rows: int) -> _Cuts:
    """Quantile cuts of every hot piece where the value has more than one."""
    names = [f"_k{i}" for i in range(len(keys))]
    if keys:
        df = df.join(_local(df, keys, [tuple(r[k] for k in keys) for r in hot], []), _match(keys, names), "left_semi")
    at = [(i + 1) / (CUTS + 1) for i in range(CUTS)]
    found = df.groupBy(*keys).agg(
        F.percentile_approx(value, at, 10_000).alias("_cuts"), F.max(value).alias("_top"),
        (F.min(name).eqNullSafe(F.max(name)) & F.count(name).isin(0, F.count(F.lit(1)))).alias("_one")).collect()
    sizes = {tuple(r[k] for k in keys): r["_n"] for r in hot}
    rows = []
    for r in found:
        key = tuple(r[k] for k in keys)
        step = max(1, CUTS * hot_rows // (2 * sizes[key]))
        cuts = sorted({c for c in r["_cuts"][::step] if c < r["_top"]})
        if cuts:
            rows.append((*key, cuts))
    return _Cuts(rows, all(r["_one"] for r in found))


def _cut(df: DataFrame, keys: list[str], value: Column, rows: list[tuple], piece: str) -> DataFrame:
    names = [f"_k{i}" for i in range(len(keys))]
    table = _local(df, keys, rows, [T.StructField("_cuts", T.ArrayType(T.DoubleType()))])
    number = F.when(F.col("_cuts").isNotNull(), F.size(F.filter("_cuts", lambda c: c < value)))
    joined = df.join(table, _match(keys, names) if keys else F.lit(True), "left")
    return joined.withColumn(piece, number).drop(*names, "_cuts")


def _offsets(df: DataFrame, group_cols: list[str], pieces: list[str], hit_col: str | None) -> DataFrame:
    """Rows and hits of the earlier pieces of each piece of a hot group."""
    keys = [*group_cols, *pieces]
    hits = F.sum(hit_col) if hit_col else F.lit(0)
    parts = df.where(F.col(pieces[0]).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), hits.cast("long").alias("_hits"))
    w = (Window.partitionBy(*(group_cols or [F.lit(0)])).orderBy(*[F.col(p).asc_nulls_first() for p in pieces])
         .rowsBetween(Window.unboundedPreceding, -1))
    return parts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                        F.coalesce(F.sum("_rows").over(w), F.lit(0)).alias("_rows_before"),
                        F.coalesce(F.sum("_hits").over(w), F.lit(0)).alias("_hits_before"))


def ordered_index(df: DataFrame, group_cols: list[str], order: Order, out_col: str,
                  hit_col: str | None = None, cum_col: str | None = None,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``out_col`` = 0-based position of each row in its group under ``order``.

    With ``hit_col`` (0/1) also add ``cum_col`` = hits up to and including the
    row. ``order`` must be a total order within a group (add a unique
    tie-break column) for the result to be deterministic.
    """
    cut, pieces = cut_hot_groups(df, group_cols, order, hot_rows)
    keys = [*group_cols, *pieces]
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order_by(order))
    out = cut.withColumn(out_col, F.row_number().over(w).cast("long") - 1)
    if hit_col and cum_col:
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn(cum_col, F.sum(hit_col).over(upto).cast("long"))
    if pieces:
        # One row a piece of a hot group: at most a few times rows / hot_rows.
        before = F.broadcast(_offsets(cut, group_cols, pieces, hit_col))
        out = out.join(before, _match(keys, [f"_k{i}" for i in range(len(keys))]), "left")
        out = out.withColumn(out_col, F.col(out_col) + F.coalesce("_rows_before", F.lit(0)))
        if hit_col and cum_col:
            out = out.withColumn(cum_col, F.col(cum_col) + F.coalesce("_hits_before", F.lit(0)))
    added = [c for c in (out_col, cum_col if hit_col else None) if c]
    return out.select(*[c for c in df.columns if c not in added], *added)
