"""Multi-shard scan with a global row index; tolerant metadata scan.

S7 without a global sort: each row's ``event_order`` is the number of rows in
all earlier files (in manifest order) plus its own ``_metadata.row_index``.
Per-file counts are one partially aggregated job; the cumulative offsets are
computed on the file-level table (one row per file) and broadcast back, a
size bound that is the file count, not the data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import EVENT_ORDER
from .catalog import _sql_str, week_col

FILE, ROW = "_file", "_row"


def scan(spark: SparkSession, files: list[str], schema=None) -> DataFrame:
    """One scan over the shards (union-all of the files)."""
    if not files:
        raise ValueError("no interaction shards to scan")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(*files)


def with_row_index(df: DataFrame, root: str) -> DataFrame:
    """Add ``event_order`` = file offset + row index, files in (week, path) order."""
    bare = root.rstrip("/")
    bare = bare.split(":", 1)[1] if bare.startswith("file:") else bare
    src = df.select("*", F.col("_metadata.file_path").alias(FILE),
                    F.col("_metadata.row_index").alias(ROW))
    per_file = src.groupBy(FILE).agg(F.count(F.lit(1)).alias("_rows"))
    rel = F.expr(f"substring({FILE}, locate({_sql_str(bare)}, {FILE}) + {len(bare) + 1})").alias("rel")
    per_file = per_file.select(FILE, "_rows", rel).withColumn("week", week_col("rel"))
    w = Window.orderBy("week", FILE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select(FILE, F.coalesce(F.sum("_rows").over(w), F.lit(0)).alias("_off"))
    # One row per input file: bounded by the manifest, not by the rows.
    out = src.join(F.broadcast(offsets), FILE, "left")
    return out.withColumn(EVENT_ORDER, (F.col("_off") + F.col(ROW)).cast("long")).drop(FILE, ROW, "_off")


def scan_meta(spark: SparkSession, files: list[str], keep: list[str]) -> DataFrame | None:
    """Optional metadata; keep the wanted columns that exist, None if no files."""
    if not files:
        return None
    df = spark.read.parquet(*sorted(files))
    cols = [c for c in keep if c in df.columns]
    return df.select(*cols)
