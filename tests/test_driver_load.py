"""What goes through the driver or one task stays bounded: stages run once, large sides are
shuffled whatever their compressed size, sorted sinks have tasks of bounded rows."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rankbeam.config import SPLIT, Config
from rankbeam.operators import clean as cl
from rankbeam.operators.joins import bounded_broadcast, shuffled_if_large
from rankbeam.plans import job, sinks
from rankbeam.plans import testdata as td

CFG = Config().with_cleaning(max_timespent_sec=200.0, min_user_interactions=1, min_item_interactions=1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    n = F.col("id")
    made = {
        "events": spark.range(600).select(
            n.alias("event_id"), F.timestamp_micros(n * 3_600_000_000).alias("ts"), (n % 12).alias("user_id"),
            F.element_at(F.array(*[F.lit(x) for x in ("click", "error", "purchase", "signup", "view")]),
                         (n % 5 + 1).cast("int")).alias("event_type"),
            (n % 90).cast("double").alias("value"),
            F.format_string('{"k": %d}', (n * 7) % 10).alias("props")),
        "part": spark.range(10).select(n.alias("p_partkey"), (n + 5).cast("int").alias("p_size"),
                                       F.format_string("Brand#%d", n % 3).alias("p_brand")),
        "customer": spark.range(12).select(n.alias("c_custkey"), (n % 2).cast("int").alias("c_nationkey"),
                                           (n * 400).cast("double").alias("c_acctbal"), F.lit("SEG").alias("c_mktsegment")),
        "nation": spark.range(2).select(n.cast("int").alias("n_nationkey"), F.format_string("N%d", n).alias("n_name")),
        "embeddings": spark.range(10).select(n.alias("vec_id"), F.array(*[
            F.sin(n + k).cast("float") for k in range(4)]).alias("embedding")),
    }
    for name, df in made.items():
        df.write.parquet(f"{d}/{name}.parquet")
    return d


def _given(df) -> list[str]:
    return [f for f in df.inputFiles() if any(f"/{t}.parquet" in f for t in ("events", "part", "customer"))]


def test_stage_hands_on_written_rows(spark, tables):
    """F8: what follows reads the written interactions; both sides of a join, too."""
    st = td.Stage(spark, tables, CFG)
    want = td.interactions(spark, tables, CFG)
    assert st.inter.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, st.inter.collect())) == sorted(map(tuple, want.collect()))
    both = st.inter.join(st.inter.groupBy("user_id").count(), "user_id")
    assert not _given(both) and "c_custkey" not in _plan(both)


def test_fits_read_written_rows(spark, tables, monkeypatch):
    """The fits and the join of two scored frames do not assemble the dataset again."""
    from rankbeam.operators import ranker as rkr

    seen = []
    monkeypatch.setattr(td, "TD_CFG", CFG.with_model(loss="pointwise", max_iter=2, max_depth=2, metric_period=1,
                                                     early_stop=False))
    monkeypatch.setattr(td, "_FITS", {})

    def dataset(spark, sf_dir):
        st = td.Stage(spark, sf_dir, CFG)
        return td.ds.assemble(st.inter, st.feats, st.bounds, st.cfg, st.vectors())

    monkeypatch.setattr(td, "_dataset", dataset)
    fit = rkr.fit
    monkeypatch.setattr(rkr, "fit", lambda d, meta, cfg: seen.append(d) or fit(d, meta, cfg))
    d, _, _ = td._fit(spark, tables)
    td.q_ranking_fit(spark, tables)
    assert len(seen) == 2
    for got in (d, *seen):
        assert got.count() == 600 and {r[0] for r in got.select(SPLIT).distinct().collect()} == {"train", "val", "test"}
        assert "Join" not in _plan(got) and "InMemoryTableScan" not in _plan(got)


def test_large_sides_are_shuffled_whatever_the_planner_thinks(spark):
    """A small compressed size does not make a table above the limits a broadcast."""
    big = spark.range(100).withColumnRenamed("id", "k")
    fact = spark.range(1000).select((F.col("id") % 120).alias("k"))
    assert "Broadcast" not in _plan(fact.join(bounded_broadcast(big, 50), "k", "left"))
    scale = replace(CFG.scale, broadcast_max_rows=50)
    assert "Broadcast" not in _plan(fact.join(shuffled_if_large(big, scale), "k", "left"))
    assert "Broadcast" in _plan(fact.join(shuffled_if_large(big, CFG.scale), "k", "left"))


def test_large_metadata_is_shuffled(spark, tables):
    cfg = CFG.with_cleaning(max_timespent_sec=150.0)  # nothing cached by another test
    small = replace(cfg, scale=replace(cfg.scale, broadcast_max_rows=5))
    cut = td.interactions(spark, tables, small)
    assert "SortMergeJoin" in _plan(cut) and "p_partkey" in _plan(cut)
    assert "BroadcastHashJoin [user_id" not in _plan(cut) and "BroadcastHashJoin [item_id" not in _plan(cut)
    plain = td.interactions(spark, tables, cfg)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, cut.collect()))
    log = td.norm_log(spark, tables, small)
    items = td.ad.item_meta(spark, tables)
    assert "BroadcastHashJoin" not in _plan(cl.enrich(log, items, None, small))


def test_sorted_sinks_have_bounded_tasks(spark, monkeypatch):
    """small files of many rows are many tasks."""
    rows = sinks.TARGET_PARTITION_ROWS
    assert sinks.sorted_partitions(None, 0) == 1 and sinks.sorted_partitions(1, rows) == 1
    assert sinks.sorted_partitions(1, 10 * rows + 1) == 11
    assert sinks.sorted_partitions(10 * sinks.TARGET_PARTITION_BYTES + 1, 1) == 11
    monkeypatch.setattr(job.cat, "total_bytes", lambda man, category: 1000)
    monkeypatch.setattr(sinks, "TARGET_PARTITION_ROWS", 100)
    assert job._parts(None, spark.range(1001)) == 11


def test_job_writes_in_bounded_tasks(spark, tables, monkeypatch, tmp_path):
    """the job's files hold no more than about the rows of a task, all rows once."""
    from rankbeam.sources import shard_tree

    monkeypatch.setattr(sinks, "TARGET_PARTITION_ROWS", 100)
    out = str(tmp_path / "out")
    root = shard_tree.write_tree(spark, tables, str(tmp_path / "raw"))
    job.run(spark, root, out, CFG, job.STAGES[:-1])
    for name in ("interactions", "dataset"):
        got = spark.read.parquet(f"{out}/{name}")
        assert got.count() == 600 and got.select("event_order").distinct().count() == 600
        per_file = got.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0]
        assert per_file <= 250
