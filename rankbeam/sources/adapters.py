"""Map the provided test tables onto the interaction roles.

These functions only rename and project columns of the given tables into the
schema the job expects (log, item metadata, user metadata, item vectors).
They do none of the job's work.

Adapter A (``events``): one event per row; ``event_id`` is the time order.
Adapter B (``lineitem`` x ``orders``): one line item per row (bench scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EVENT_ORDER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One provided test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Event type -> feedback flag of adapter A.
EVENT_TYPE_FLAGS = (
    ("like", "click"),
    ("dislike", "error"),
    ("share", "purchase"),
    ("bookmark", "signup"),
)


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter A: ``events`` as an interaction log with ``event_order``."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    flags = [(F.col("event_type") == F.lit(t)).cast("tinyint").alias(f)
             for f, t in EVENT_TYPE_FLAGS]
    return ev.select(
        eid.alias(EVENT_ORDER),
        F.col("user_id"),
        F.expr("try_cast(get_json_object(props, '$.k') AS bigint)").alias("item_id"),
        F.col("value").alias("timespent"),
        *flags,
        (eid % 20 == 0).cast("tinyint").alias("click_on_author"),
        (eid % 25 == 0).cast("tinyint").alias("open_comments"),
        F.concat(F.lit("pl"), (eid % 3).cast("string")).alias("place"),
        F.concat(F.lit("pf"), (eid % 4).cast("string")).alias("platform"),
        F.concat(F.lit("ag"), (eid % 2).cast("string")).alias("agent"),
    )


def item_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item dimension: ``part`` as (item_id, duration, author_id)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_size").alias("duration"),
        F.col("p_brand").alias("author_id"),
    )


def user_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension: ``customer`` (+ ``nation`` name) as (user_id, age, gender, geo)."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # A plain join: the planner broadcasts nation from its measured size.
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left").select(
        F.col("c_custkey").alias("user_id"),
        F.floor(F.abs(F.col("c_acctbal")) / 200).cast("bigint").alias("age"),
        F.col("c_mktsegment").alias("gender"),
        F.col("n_name").alias("geo"),
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item vectors: every row of ``embeddings``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("item_id"),
        F.col("embedding"),
    )


# Adapter B flag thresholds on lineitem columns.
B_DISCOUNT_LIKE = 0.05
B_TAX_SHARE = 0.06


def lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B: ``lineitem`` x ``orders`` as an interaction log without order.

    ``event_order`` is assigned by the job (file offsets), not here.
    The sort key columns are kept so the caller can write files in that order.
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("timespent"),
        (F.col("l_discount") >= B_DISCOUNT_LIKE).cast("tinyint").alias("like"),
        (F.col("l_returnflag") == "R").cast("tinyint").alias("dislike"),
        (F.col("l_tax") >= B_TAX_SHARE).cast("tinyint").alias("share"),
        (F.col("l_linestatus") == "O").cast("tinyint").alias("bookmark"),
        (F.col("l_returnflag") == "A").cast("tinyint").alias("click_on_author"),
        (F.col("l_discount") == 0).cast("tinyint").alias("open_comments"),
        F.concat(F.lit("pl"), (F.col("l_linenumber") % 3).cast("string")).alias("place"),
        F.concat(F.lit("pf"), F.col("l_returnflag")).alias("platform"),
        F.concat(F.lit("ag"), F.col("l_linestatus")).alias("agent"),
        "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
    )


B_ORDER_KEY = ("l_shipdate", "l_orderkey", "l_linenumber", "item_id", "l_suppkey",
               "l_extendedprice")
