"""Write adapter A as the raw folder layout the job ingests.

Layout (FIXTURES.md): weekly interaction shards ``train/week_NN.parquet``,
``validation/week_NN.parquet`` (second-to-last week), ``test/week_NN.parquet``
(last week), ``metadata/users_metadata.parquet``,
``metadata/items_metadata.parquet`` and NPZ archives under
``metadata/item_embeddings/``. Shards hold the raw interaction columns only;
no ``event_order`` is stored (the job derives it from file positions).
This builds input only; it does none of the job's work.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import EVENT_ORDER, Config
from ..operators.joins import shuffled_if_large
from ..session import scratch_path
from . import adapters as ad
from .embeddings import write_npz

WEEK_US = 7 * 24 * 3600 * 1_000_000
_CACHE: dict[tuple[str, str], str] = {}


def wall_micros(spark: SparkSession, ts_col: str):
    """Microseconds of a wall-clock (TIMESTAMP_NTZ) value read as UTC, any session zone."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    return F.unix_micros(F.to_utc_timestamp(F.col(ts_col).cast("timestamp"), tz))


def week_index(spark: SparkSession, ts_col: str, t0_us: int):
    return F.floor((wall_micros(spark, ts_col) - F.lit(t0_us)) / F.lit(WEEK_US)).cast("int")


def write_tree(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Write adapter A as the raw folder layout; returns its root."""
    root = root or scratch_path(spark, "raw")
    ev = ad.table(spark, sf_dir, "events").select("event_id", "ts")
    log = ad.events_log(spark, sf_dir)
    t0 = ev.agg(F.min(wall_micros(spark, "ts"))).first()[0]
    times = shuffled_if_large(ev.select(F.col("event_id").alias(EVENT_ORDER), "ts"), Config().scale)
    rows = log.join(times, EVENT_ORDER)
    rows = rows.withColumn("_week", week_index(spark, "ts", t0))
    weeks = sorted(r["_week"] for r in rows.select("_week").distinct().collect())
    raw_cols = [c for c in log.columns if c != EVENT_ORDER]
    for w in weeks:
        folder = "test" if w == weeks[-1] else ("validation" if len(weeks) > 1 and w == weeks[-2]
                                                else "train")
        shard = rows.where(F.col("_week") == w).orderBy(EVENT_ORDER).select(*raw_cols)
        shard.write.mode("overwrite").parquet(f"{root}/{folder}/week_{w:02d}.parquet")
    ad.user_meta(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/metadata/users_metadata.parquet")
    ad.item_meta(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/metadata/items_metadata.parquet")
    write_npz(ad.item_vectors(spark, sf_dir), f"{root}/metadata/item_embeddings")
    return root


def cached_tree(spark: SparkSession, sf_dir: str) -> str:
    """``write_tree`` once per application and test-table folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = write_tree(spark, sf_dir)
    return _CACHE[key]



def write_lineitem_tree(spark: SparkSession, sf_dir: str, root: str | None = None,
                        num_files: int | None = None) -> str:
    """Adapter B as a raw folder: one shard folder whose part files follow the
    log order (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_extendedprice); the job numbers rows from these file positions."""
    root = root or scratch_path(spark, "raw-b")
    log = ad.lineitem_log(spark, sf_dir)
    ordered = (log.repartitionByRange(num_files, *ad.B_ORDER_KEY) if num_files
               else log.repartitionByRange(*ad.B_ORDER_KEY)).sortWithinPartitions(*ad.B_ORDER_KEY)
    raw_cols = [c for c in log.columns if c not in ad.B_ORDER_KEY or c == "item_id"]
    ordered.select(*raw_cols).write.mode("overwrite").parquet(f"{root}/log/week_00.parquet")
    ad.user_meta(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/metadata/users_metadata.parquet")
    ad.item_meta(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/metadata/items_metadata.parquet")
    write_npz(ad.item_vectors(spark, sf_dir), f"{root}/metadata/item_embeddings")
    return root
