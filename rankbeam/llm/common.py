"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path, ship_package

__all__ = ["components", "crc_bucket", "discard", "prepare", "read_table", "shield",
           "slices", "text_buffers", "written"]


def prepare(spark: SparkSession) -> SparkSession:
    """Shared folder set and package importable by the Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once nothing that is still to run reads them."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.written_path)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shield(docs: DataFrame, reserved: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with its columns of ``reserved`` names, or of names that begin with ``__``,
    renamed; and a function that selects all columns of ``docs`` again, by their own names.
    What runs in between may add columns of the reserved names."""
    taken = {c.lower() for c in docs.columns}
    names = {}
    for i, c in enumerate(docs.columns):
        if c.lower() in reserved or c.startswith("__"):
            new = f"held_{i}"
            while new in taken:
                new += "_"
            names[c] = new
    own = [F.col(f"`{c}`") for c in docs.columns]
    hidden = docs.select(*[x.alias(names.get(c, c)) for c, x in zip(docs.columns, own, strict=True)])
    return hidden, lambda df: df.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns])


def crc_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(buckets)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arrow strings as (UTF-8 bytes, offsets, is-null) without Python strings."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    nulls = np.asarray(col.is_null())
    return raw[off[0]:off[-1]], off - off[0], nulls


def slices(batches: Iterator[pa.RecordBatch], column: str,
           max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of about ``max_bytes`` of text (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off, _ = text_buffers(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(off, off[at] + max_bytes, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def _signature(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b: long).

    Alternating large-star and small-star rounds; each round is two grouped
    minima and two joins, written to the shared folder, until the edge set is
    stable (a star around every component's smallest node). Returns (node,
    component) for every node that has an edge; no edges give no rows; self
    loops and null ends are ignored.
    """
    e = (edges.where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = written(e, f"{name}-0")
    seen = _signature(e)
    for i in range(1, max_rounds + 1):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a").where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low2.select("a", F.col("m").alias("b"))).distinct())
        before, e = e, written(small, f"{name}-{i}")
        discard(before)
        now = _signature(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
