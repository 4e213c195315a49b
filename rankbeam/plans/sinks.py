"""Sinks: S11 (Parquet tables), S13 (per-event cosine), S14-S15 (run metrics)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import EVENT_ORDER, SPLIT, SPLITS, Config
from ..operators.clean import row_stats, sort_by_order
from ..operators.dataset import grouped_layout
from ..session import scratch_path


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Overwrite a Parquet table; returns the path (a lineage cut)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def partitions_for(input_bytes: int | None, target: int = TARGET_PARTITION_BYTES) -> int | None:
    """Range partitions so each task handles about ``target`` input bytes."""
    if not input_bytes:
        return None
    return max(1, -(-int(input_bytes) // target))


#: Rows that one task sorts before it writes them.
TARGET_PARTITION_ROWS = 250_000


def sorted_partitions(input_bytes: int | None, rows: int) -> int:
    """Range partitions of a sorted sink: few bytes of input may be many rows, and the written
    rows are wider than the input's."""
    return max(partitions_for(input_bytes) or 1, -(-int(rows) // TARGET_PARTITION_ROWS))


def write_interactions(inter: DataFrame, path: str, num_partitions: int | None = None,
                       globally: bool = True, seen: Observation | None = None) -> str:
    """S11 + O1: interactions sorted by ``event_order``.

    ``globally``: range-partitioned, so files hold disjoint, ordered ranges
    (one shuffle plus Spark's sampling pass). Otherwise each task sorts its
    own rows: no shuffle; files are sorted but their ranges may overlap. ``seen``
    takes the statistics (A2) of the rows as they are written.
    """
    laid = sort_by_order(inter, num_partitions) if globally else inter.sortWithinPartitions(EVENT_ORDER)
    if seen is not None:  # after the range shuffle, whose sampling pass also runs what is below it
        laid = laid.observe(seen, *row_stats())
    return write_table(laid, path)


def write_grouped_splits(ds: DataFrame, cfg: Config, path: str | None = None,
                         num_partitions: int | None = None, seen: Observation | None = None) -> str:
    """S11 + O2: the dataset in one write, one folder per split, users contiguous.

    A frame assembled with ``layout=True`` is already in that layout. ``seen`` takes the
    rows per split (A11) as they are written.
    """
    path = path or scratch_path(ds.sparkSession, "dataset")
    laid = ds if getattr(ds, "_rb_layout", False) else grouped_layout(ds, cfg, num_partitions)
    if seen is not None:
        laid = laid.observe(seen, *[F.count_if(F.col(SPLIT) == s).alias(s) for s in SPLITS])
    return write_table(laid, path, [SPLIT])


def write_cosine(df: DataFrame, path: str) -> str:
    """(event_order, emb_cos) table, written by every task in parallel."""
    return write_table(df.select(EVENT_ORDER, "emb_cos"), path)


def metrics_frame(spark: SparkSession, run_id: str, stage: str, values: dict) -> DataFrame:
    """Tracking scalars as rows (run_id, stage, name, value)."""
    rows = [(run_id, stage, str(k), float(v)) for k, v in values.items()]
    return spark.createDataFrame(rows, "run_id string, stage string, name string, value double")


def append_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_json_row(df: DataFrame, path: str) -> None:
    """A one-row report (stats, bounds, metrics) as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def meta_json(meta) -> str:
    return json.dumps(meta.__dict__, sort_keys=False)


