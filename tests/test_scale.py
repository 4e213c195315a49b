"""Scale properties: hot groups are split, results do not depend on partitioning,
filters reach the scan, broadcasts are bounded."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankbeam.config import Config
from rankbeam.operators import features as ft
from rankbeam.operators import ranking as rk
from rankbeam.operators.ordering import cut_hot_groups, ordered_index
from rankbeam.plans import sinks
from rankbeam.session import scratch_path


def _hot(spark, n=4000, hot_share=0.5, seed=1):
    rng = np.random.default_rng(seed)
    users = np.where(rng.random(n) < hot_share, 0, rng.integers(1, 50, n))
    rows = [(int(u), float(rng.integers(0, 4)), float(rng.random()), i) for i, u in enumerate(users)]
    return spark.createDataFrame(rows, "g long, y double, s double, eo long")


def test_hot_group_is_cut_into_pieces(spark):
    df = _hot(spark)
    cut, pieces = cut_hot_groups(df, ["g"], [("s", False), ("eo", True)], hot_rows=100)
    assert pieces and cut.where("g <> 0 and _piece0 is not null").count() == 0
    assert cut.groupBy("g", *pieces).count().agg(F.max("count")).first()[0] <= 100


@pytest.mark.parametrize("column", ["eo", "s", "flat", "word", "day", "gone"])
def test_pieces_follow_the_order(spark, column):
    """One value for all rows, strings with a common start, dates, nulls and NaN."""
    df = _hot(spark, n=600).selectExpr(
        "g", "eo", "s", "1.5 as flat", "concat('prefix', lpad(eo % 40, 2, '0')) as word",
        "date_add(date'2024-01-01', cast(eo % 50 as int)) as day",
        "case when eo % 3 = 0 then null when eo % 3 = 1 then double('nan') else s end as gone")
    for up in (True, False):
        order = [(column, up), ("eo", True)]
        plain = ordered_index(df, ["g"], order, "pos").select("eo", "pos")
        cut = ordered_index(df, ["g"], order, "pos", hot_rows=100).select("eo", F.col("pos").alias("cut"))
        assert plain.join(cut, "eo").where("pos = cut").count() == 600


def test_positions_independent_of_pieces(spark):
    df = _hot(spark, n=1500)
    ref = None
    for hot in (10**6, 300, 50):
        got = sorted((r["eo"], r["pos"]) for r in ordered_index(
            df, ["g"], [("s", False), ("eo", True)], "pos", hot_rows=hot).collect())
        ref = ref or got
        assert got == ref
    # positions of the hot group are 0..n-1
    hot = sorted(p for e, p in ref if e in {r["eo"] for r in df.where("g = 0").collect()})
    assert hot == list(range(len(hot)))
    whole = ordered_index(df, [], [("eo", True)], "pos", hot_rows=100)
    assert whole.where("pos <> eo").count() == 0 and whole.columns == [*df.columns, "pos"]


def test_metrics_independent_of_pieces(spark):
    df = _hot(spark, n=2000)
    vals = [rk.ranking_metrics(df, ["g"], "y", "s", "eo", ks=(5, 10), hot_rows=hot).first().asDict()
            for hot in (10**6, 100)]
    for v in vals[1:]:
        for k in v:
            assert v[k] == pytest.approx(vals[0][k], abs=1e-12)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(0, 5)), min_size=1, max_size=60))
def test_metric_ranges_and_perfect_ranking(spark, rows):
    data = [(g, float(y), float(s), i) for i, (g, y, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "g long, y double, s double, eo long")
    m = rk.ranking_metrics(df, ["g"], "y", "s", "eo", ks=(3,)).first().asDict()
    for k, v in m.items():
        if k != "n_groups":
            assert 0.0 <= v <= 1.0 + 1e-12, k
    perfect = rk.single_metric(df, "ndcg", ["g"], "y", "y", "eo", k=3).first()[0]
    has_gain = any(y > 0 for _, y, _ in rows)
    assert perfect == pytest.approx(1.0 if has_gain else 0.0)


def test_train_window_pushed_to_scan(spark):
    path = scratch_path(spark, "pushdown")
    spark.range(0, 1000).withColumnRenamed("id", "event_order").withColumn("x", F.lit(1)) \
        .write.parquet(path)
    df = ft.train_window(spark.read.parquet(path), ft.Bounds(800, 900))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan(event_order,800)" in plan
    val = spark.read.parquet(path).where(ft.split_predicate(ft.Bounds(800, 900), "val"))
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_order,800)" in plan


def test_bounded_broadcast_respects_limit(spark):
    from rankbeam.operators.joins import bounded_broadcast

    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(100).withColumnRenamed("id", "k")
    fact = spark.range(1000).select((F.col("id") % 100).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p1 = fact.join(bounded_broadcast(small, 50), "k")._jdf.queryExecution().executedPlan().toString()
        p2 = fact.join(bounded_broadcast(big, 50), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in p1 and "BroadcastHashJoin" not in p2


def test_partitions_for():
    assert sinks.partitions_for(None) is None
    assert sinks.partitions_for(1) == 1
    assert sinks.partitions_for(10 * sinks.TARGET_PARTITION_BYTES + 1) == 11


def test_cfg_is_frozen():
    with pytest.raises(Exception):
        Config().cleaning.max_timespent_sec = 1


def test_byte_bound_blocks_wide_tables(spark):
    from rankbeam.operators.joins import bounded_broadcast, row_bytes

    wide = spark.range(100).select("id", *[F.lit(1.0).alias(f"c{i}") for i in range(40)])
    assert row_bytes(wide.schema) == 16 + 8 + 40 * 8
    assert getattr(bounded_broadcast(wide, 1000, max_bytes=100 * 344), "_rb_broadcast")
    assert not getattr(bounded_broadcast(wide, 1000, max_bytes=100 * 343), "_rb_broadcast")


def test_metrics_plan_is_one_pass(spark):
    """All metrics for all k: one exchange of the rows, no Python, pushed split range."""
    path = scratch_path(spark, "onepass")
    spark.range(0, 3000).select((F.col("id") % 40).alias("user_id"), F.col("id").alias("event_order"),
                                (F.col("id") % 5).cast("float").alias("label"),
                                (F.col("id") % 7).cast("double").alias("score")).write.parquet(path)
    df = spark.read.parquet(path)
    val = df.where(ft.split_predicate(ft.Bounds(2000, 2500), ("val", "test")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        m = rk.ranking_metrics(val, ["user_id"], "label", "score", "event_order", ks=(5, 10, 20))
        plan = m._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("hashpartitioning") == 1
    assert "Pandas" not in plan and "Python" not in plan and "InMemoryTableScan" not in plan
    assert "PushedFilters: [Or(" in plan or "GreaterThanOrEqual(event_order,2000)" in plan
