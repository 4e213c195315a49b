"""Join helpers: broadcast a side only behind a checked size."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed sizes in bytes per value, used to estimate a row's in-memory width.
_FIXED = {
    T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
    T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}
STRING_BYTES = 20


_HELD: list[list[DataFrame]] = []


def hold(df: DataFrame) -> DataFrame:
    """``df`` persisted; the innermost ``releasing`` block unpersists it at its end."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if _HELD:
        _HELD[-1].append(df)
    return df


@contextmanager
def releasing() -> Iterator[None]:
    """Unpersist what ``hold`` persisted inside, e.g. when a stage has written its product."""
    _HELD.append([])
    try:
        yield
    finally:
        for df in _HELD.pop():
            df.unpersist()


def value_bytes(dt: T.DataType, array_len: int) -> int:
    """Estimated bytes of one value of type ``dt`` (arrays at ``array_len`` elements)."""
    for cls, n in _FIXED.items():
        if isinstance(dt, cls):
            return n
    if isinstance(dt, T.ArrayType):
        return 16 + array_len * value_bytes(dt.elementType, array_len)
    if isinstance(dt, T.StructType):
        return sum(value_bytes(f.dataType, array_len) for f in dt.fields)
    if isinstance(dt, T.DecimalType):
        return 16
    return STRING_BYTES


def row_bytes(schema: T.StructType, array_len: int = 64) -> int:
    """Estimated width of one row (arrays counted at ``array_len`` elements)."""
    return 16 + sum(value_bytes(f.dataType, array_len) for f in schema.fields)


def bounded_broadcast(df: DataFrame, max_rows: int, persist: bool = True,
                      max_bytes: int | None = None, array_len: int = 64) -> DataFrame:
    """Return ``F.broadcast(df)`` if ``df`` is within ``max_rows`` and ``max_bytes``.

    The row count is an action; the frame is persisted first so the join
    reuses the counted rows instead of recomputing them. The byte check is
    count x estimated row width. Above either bound the frame asks for a shuffle
    join: the planner's own sizes are compressed ones, many times below what a
    broadcast holds (AQE still splits skewed partitions).
    """
    if persist:
        df = hold(df)
    n = df.count()
    fits = n <= max_rows
    if fits and max_bytes is not None:
        fits = n * row_bytes(df.schema, array_len) <= max_bytes
    if fits:
        out = F.broadcast(df)
        out._rb_broadcast = True
        return out
    out = df.hint("merge")
    out._rb_broadcast = False
    return out


def shuffled_if_large(df: DataFrame, scale) -> DataFrame:
    """``df`` as is within the limits of a ``Scale`` config, the planner's choice; above them
    it asks for a shuffle join. For tables read from files, whose rows are counted from footers."""
    n = df.count()
    small = n <= scale.broadcast_max_rows and n * row_bytes(df.schema) <= scale.broadcast_max_bytes
    return df if small else df.hint("merge")


def sized_broadcast(df: DataFrame, scale, array_len: int = 64, persist: bool = True) -> DataFrame:
    """``bounded_broadcast`` with the row and byte limits of a ``Scale`` config."""
    return bounded_broadcast(df, scale.broadcast_max_rows, persist, scale.broadcast_max_bytes, array_len)


#: Rows of one join key that a single task joins.
HOT_KEY_ROWS = 1_000_000


def _same(keys: list[str], right: list[str], null_safe) -> Column:
    cond = F.lit(True)
    for a, b in zip(keys, right, strict=True):
        cond = cond & (F.col(a).eqNullSafe(F.col(b)) if a in null_safe else F.col(a) == F.col(b))
    return cond


def skew_join(df: DataFrame, dim: DataFrame, keys: list[str], spread: str, null_safe: tuple[str, ...] = (),
              hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Left join with a table that has one row a key, for keys of any frequency.

    Keys with more than ``hot_rows`` rows are measured first; null, which matches nothing
    unless its column is ``null_safe``, is a key like the others. There are at most rows /
    ``hot_rows`` of them, so they come to the driver. A hot key's rows are dealt into parts
    by a hash of the column ``spread``, and its one row of ``dim`` is repeated for each part.
    """
    names = [f"_d{i}" for i in range(len(keys))]
    dim = dim.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
                     *[c for c in dim.columns if c not in keys])
    hot = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(hot_rows)).alias("_parts")).where("_parts > 1").collect()
    if not hot:
        return df.join(dim, _same(keys, names, null_safe), "left").drop(*names)
    held = T.StructType([T.StructField(f"_h{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
                        + [T.StructField("_parts", T.LongType())])
    parts = F.broadcast(df.sparkSession.createDataFrame([tuple(r) for r in hot], held))
    own = [f"_h{i}" for i in range(len(keys))]
    salt = F.coalesce(F.pmod(F.xxhash64(spread), F.col("_parts")), F.lit(0).cast("long"))
    left = df.join(parts, _same(keys, own, keys), "left").withColumn("_salt", salt).drop(*own, "_parts")
    right = dim.join(parts, _same(names, own, names), "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1).cast("long")) - 1))).drop(
        *own, "_parts")
    cond = _same(keys, names, null_safe) & (F.col("_salt") == F.col("_part"))
    return left.join(right, cond, "left").drop(*names, "_salt", "_part")
