"""Preprocess stage on a tiny inline log with the reference's edge rows."""

import pytest
from pyspark.sql import functions as F

from rankbeam.config import Config
from rankbeam.functions import columns as fc
from rankbeam.operators import checks
from rankbeam.operators import clean as cl

CFG = Config().with_cleaning(min_user_interactions=3, min_item_interactions=2)
LOG_SCHEMA = ("event_order long, user_id long, item_id long, timespent double, like byte, dislike byte, "
              "share byte, bookmark byte, click_on_author byte, open_comments byte, place string, "
              "platform string, agent string")


def _row(eo, u, i, t, like=0, dislike=0, share=0, bookmark=0, coa=0, oc=0):
    return (eo, u, i, t, like, dislike, share, bookmark, coa, oc, "feed", "ios", "app")


@pytest.fixture(scope="module")
def log(spark):
    rows = []
    eo = 0
    for u in (1, 2, 3):
        for i in (10, 11, 12):
            rows.append(_row(eo, u, i, 30.0, like=int(eo % 2 == 0)))
            eo += 1
    rows.append(_row(eo, 1, 10, 10_000_000.0)); eo += 1  # dropped: too long
    rows.append(_row(eo, 2, 10, -5.0)); eo += 1  # dropped: negative
    rows.append(_row(eo, 3, 10, 500.0, dislike=1, like=1)); eo += 1  # kept, ratio clipped
    rows.append(_row(eo, 999_999, 888_888, 20.0)); eo += 1  # rare user and item
    rows.append(_row(eo, None, 11, 20.0)); eo += 1  # null id
    rows.append((eo, 2, 11, 40.0, None, None, None, None, None, None, "feed", "web", "app"))  # null flags
    return spark.createDataFrame(rows, LOG_SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(10, 100, 1), (11, 60, 1), (12, 45, 2), (888_888, 30, 3)],
                                 "item_id long, duration long, author_id long")


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([(1, 20, "m", "msk"), (2, 30, "f", "spb"), (3, 40, "m", "nsk")],
                                 "user_id long, age long, gender string, geo string")


@pytest.fixture(scope="module")
def inter(log, items, users):
    return cl.preprocess(log, items, users, CFG).cache()


def test_bounds_and_clip(inter):
    rows = {r["event_order"]: r for r in inter.collect()}
    assert 9 not in rows and 10 not in rows  # 1e7 and -5 dropped
    assert rows[11]["watch_ratio"] == pytest.approx(3.0)  # 500 / 100 clipped to 3.0
    assert inter.where((F.col("watch_ratio") < 0) | (F.col("watch_ratio") > 3.0)).count() == 0


def test_rare_and_null_ids_dropped(inter):
    ids = {(r["user_id"], r["item_id"]) for r in inter.collect()}
    assert all(u != 999_999 and i != 888_888 for u, i in ids)
    assert inter.where(F.col("user_id").isNull()).count() == 0


def test_metadata_joined(inter):
    r = inter.where(F.col("user_id") == 2).first()
    assert r["gender"] == "f" and r["geo"] == "spb" and r["age"] == 30
    assert inter.where(F.col("duration").isNull()).count() == 0


def test_flags_normalised(inter):
    r = inter.where(F.col("event_order") == 14).first()
    assert (r["like"], r["dislike"], r["share"]) == (0, 0, 0)
    assert str(inter.schema["like"].dataType) == "ByteType()"


def test_label_formula_and_dislike(inter):
    assert checks.label_mismatch(inter, CFG).count() == 0
    assert inter.where((F.col("dislike") > 0) & (F.col("label") != 0)).count() == 0
    r = inter.where(F.col("event_order") == 0).first()  # like=1, ratio 0.3 -> label 2
    assert r["label"] == pytest.approx(2.0)


def test_order_unique_with_gaps(inter):
    assert checks.order_unique(inter)
    orders = sorted(r["event_order"] for r in inter.collect())
    assert orders[-1] > len(orders) - 1  # gaps from dropped rows are kept


def test_activity_filter_is_one_round(spark):
    """A user kept by the user count may fall below it after the item filter."""
    rows = [_row(0, 1, 10, 1.0), _row(1, 1, 10, 1.0), _row(2, 1, 99, 1.0),
            _row(3, 2, 10, 1.0)]
    df = spark.createDataFrame(rows, LOG_SCHEMA).withColumn("duration", F.lit(10))
    cfg = Config().with_cleaning(min_user_interactions=3, min_item_interactions=2)
    out = cl.activity_filter(df, cfg)
    got = sorted((r["user_id"], r["item_id"]) for r in out.collect())
    assert got == [(1, 10), (1, 10)]  # user 1 now has 2 < 3 rows: no second round


def test_float_threshold_compare(spark):
    df = spark.createDataFrame([(0.8,)], "x double").select(F.col("x").cast("float").alias("watch_ratio"))
    assert df.select((F.col("watch_ratio") >= fc.float_lit(0.8)).alias("b")).first()["b"] is True


def test_user_sample_deterministic(spark):
    cfg = Config().with_sample(user_fraction=0.3, seed=42)
    df = spark.range(2000).withColumnRenamed("id", "user_id")
    a = {r[0] for r in cl.sample_users(df, cfg).collect()}
    b = {r[0] for r in cl.sample_users(df.repartition(7), cfg).collect()}
    assert a == b and 450 < len(a) < 750


def test_stage_stats(inter):
    s = cl.stage_stats(inter, CFG).first()
    assert s["n_rows"] == inter.count()
    assert 0 <= s["label_pos_share"] <= 1


def test_nan_duration_dropped(spark):
    """least(NaN, 3) is 3 in Spark: a NaN duration must fail the cleaning predicate."""
    rows = [_row(0, 1, 10, 30.0), _row(1, 1, 11, 30.0)]
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    items = spark.createDataFrame([(10, float("nan"), 1), (11, 60.0, 1)],
                                  "item_id long, duration double, author_id long")
    cfg = Config().with_cleaning(min_user_interactions=1, min_item_interactions=1)
    out = cl.preprocess(log, items, None, cfg).collect()
    assert [r["item_id"] for r in out] == [11]


def test_duplicate_metadata_fans_out_and_is_reported(spark, log):
    items = spark.createDataFrame([(10, 100, 1), (10, 100, 2), (11, 60, 1), (12, 45, 2)],
                                  "item_id long, duration long, author_id long")
    assert checks.duplicate_keys(items, "item_id") == 1
    cfg = Config().with_cleaning(min_user_interactions=1, min_item_interactions=1)
    norm = cl.normalise_feedback(log, cfg)
    n10 = norm.where("item_id = 10").count()
    out = cl.enrich(norm, items, None, cfg)
    assert out.where("item_id = 10").count() == 2 * n10


def test_activity_counts_by_grouping_sets(log):
    plan = cl.activity_filter(log.na.drop(subset=["user_id", "item_id"]), CFG)._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert "Generate" not in text and "Expand" in text


def test_user_columns_join_late_only_when_ids_are_unique(spark, log, items):
    """Repeated user rows multiply events before they are counted, as the joins would."""
    users = spark.createDataFrame([(1, 20, "m", "x"), (2, 30, "f", "y"), (3, 40, "m", "z")],
                                  "user_id long, age long, gender string, geo string")
    twice = users.unionAll(users.where("user_id = 3"))
    assert cl.unique_key(users, "user_id") and not cl.unique_key(twice, "user_id")
    one, two = (cl.preprocess(log, items, u, CFG) for u in (users, twice))
    assert sorted(one.columns) == sorted(two.columns)
    n = {r["user_id"]: r["count"] for r in one.groupBy("user_id").count().collect()}
    m = {r["user_id"]: r["count"] for r in two.groupBy("user_id").count().collect()}
    assert m[3] == 2 * n[3] and m[1] == n[1]
    early = cl.add_label(cl.activity_filter(cl.add_watch_ratio(cl.clean(cl.enrich(
        cl.normalise_feedback(log, CFG), items, users, CFG), CFG), CFG), CFG), CFG)
    assert one.select(*sorted(one.columns)).exceptAll(early.select(*sorted(one.columns))).isEmpty()
