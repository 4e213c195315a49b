"""Dataset assembly: split partition, bounds, layout, types, cold rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankbeam.config import EVENT_ORDER, SPLIT, Config
from rankbeam.operators import checks
from rankbeam.operators import dataset as ds
from rankbeam.operators.joins import skew_join
from rankbeam.plans import sinks
from rankbeam.plans import testdata as td

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def built(spark):
    st = td.Stage(spark, SF)
    d, meta = ds.assemble(st.inter, st.feats, st.bounds, st.cfg, st.vectors())
    path = sinks.write_grouped_splits(d, st.cfg)
    return st, spark.read.parquet(path).cache(), meta


def test_splits_partition_events(built):
    st, d, _ = built
    cov = checks.split_coverage(st.inter, d)
    assert cov["total"] == sum(cov["per_split"].values()) and cov["overlap"] == 0


def test_bounds_respected(built):
    st, d, _ = built
    assert checks.split_bounds_respected(d, st.bounds.train_end, st.bounds.val_end).count() == 0


def test_groups_contiguous_per_file(built):
    st, d, _ = built
    rows = checks.group_runs_per_file(d, st.cfg).collect()
    assert rows and all(r["broken_runs"] == 0 and r["order_breaks"] == 0 for r in rows)


def test_feature_lists_and_types(built):
    _, d, meta = built
    assert len(meta.num_features) == 36 and len(meta.cat_features) == 5
    assert not checks.leaky_columns(meta.num_features + meta.cat_features, td.TD_CFG)
    types = dict(d.dtypes)
    assert all(types[c] == "float" for c in meta.num_features)
    assert all(types[c] == "string" for c in meta.cat_features)
    nulls = d.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in meta.cat_features]).first()
    assert all(nulls[c] == 0 for c in meta.cat_features)


def test_cold_rows_kept(built):
    st, d, _ = built
    assert d.count() == st.inter.count()
    # val/test users or pairs unseen in train keep the row with null aggregates
    cold = d.where(F.col("ua_n_events").isNull())
    assert cold.count() > 0 and cold.where(F.col(SPLIT) == "train").count() == 0


def test_head_whole_groups(spark):
    df = spark.createDataFrame([(u, e, 1.0) for u in (1, 2, 3) for e in range(4)],
                               "user_id long, event_order long, label float")
    cfg = td.TD_CFG
    got = [(r["user_id"], r[EVENT_ORDER]) for r in ds.head_whole_groups(df, 6, cfg).collect()]
    assert sorted(got) == [(1, e) for e in range(4)]  # user 2 cut at 2 rows: dropped whole
    one = ds.head_whole_groups(df.where(F.col("user_id") == 1), 2, cfg).count()
    assert one == 2  # a single group is kept even if cut


def test_pair_keyed_plan_equals_broadcast_plan(spark, built):
    """Large-user plan (one event shuffle on (user, author)) gives the same rows."""
    from dataclasses import replace

    st, _, _ = built
    small = st.cfg
    large = replace(st.cfg, scale=replace(st.cfg.scale, broadcast_max_rows=5,
                                          broadcast_max_vector_cells=5 * 32))
    a, meta = ds.assemble(st.inter, st.feats, st.bounds, small, st.vectors())
    b, _ = ds.assemble(st.inter, st.feats, st.bounds, large, st.vectors())
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan or "SortMergeJoin" in plan
    cols = a.columns

    def rows(df):
        out = {}
        for r in df.select(*cols).collect():
            out[r[EVENT_ORDER]] = tuple("nan" if isinstance(v, float) and v != v else v for v in r)
        return out

    ra, rb = rows(a), rows(b)
    assert ra.keys() == rb.keys() and len(ra) == st.inter.count()
    assert ra == rb


@pytest.mark.parametrize("kind", ["number", "text"])
def test_head_whole_groups_equals_sorting(spark, kind):
    """Every cut, users in one piece and in many; no global limit in the plan."""
    rng = np.random.default_rng(3)
    users = np.sort(rng.choice(40, 300, p=np.r_[0.4, np.full(39, 0.6 / 39)]))
    rows = [(int(u) if kind == "number" else f"user{u:03d}", int(e)) for u, e in zip(users, rng.permutation(300))]
    df = spark.createDataFrame(rows, f"user_id {'long' if kind == 'number' else 'string'}, event_order long")
    rows.sort()
    for n in (1, 60, 299, 300, 900):
        head = rows[:n]
        groups = {u for u, _ in head}
        want = [r for r in head if len(groups) == 1 or r[0] != head[-1][0]]
        for piece in (10**6, 9):
            out = ds.head_whole_groups(df, n, Config(), piece)
            assert sorted(tuple(r) for r in out.collect()) == want, (n, piece)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "SinglePartition" not in plan
    assert ds.head_whole_groups(df.limit(0), 5, Config()).count() == 0


def test_skew_join_equals_the_plain_join(spark):
    """A key with a third of all rows, null keys that match or do not, keys without a row."""
    df = spark.range(900).select(
        F.col("id").alias("eo"), F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 5 != 0, F.col("id") % 50).alias("a"),
        (F.col("id") % 4).alias("u"))
    dim = spark.createDataFrame([(u, a, u * 100 + (a or 0)) for u in range(3) for a in [*range(40), None]],
                                "u long, a long, v long")
    for safe in ((), ("a",)):
        want = df.join(dim.withColumnsRenamed({"u": "u2", "a": "a2"}),
                       (F.col("u") == F.col("u2")) & (F.col("a").eqNullSafe(F.col("a2")) if safe else
                                                      F.col("a") == F.col("a2")), "left").select("eo", "a", "u", "v")
        for hot in (10**6, 20):
            got = skew_join(df, dim, ["u", "a"], "eo", safe, hot)
            assert got.columns == ["eo", "a", "u", "v"] and got.exceptAll(want).isEmpty() and got.count() == 900
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_part" in plan
