"""Sources: file catalog, week order, global row index, metadata, NPZ."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankbeam.config import Sources
from rankbeam.session import local_fs_path, scratch_path
from rankbeam.sources import catalog as cat
from rankbeam.sources import embeddings as emb
from rankbeam.sources import npz
from rankbeam.sources import shard_tree
from rankbeam.sources import shards as sh

SF = "/root/testdata/sf0.001"


def _touch_tree(root, rels):
    for r in rels:
        p = os.path.join(root, r)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(b"x")


def test_category_precedence_and_week_order(spark, tmp_path):
    root = str(tmp_path / "raw")
    _touch_tree(root, [
        "train/week_00.parquet", "test/week_26.parquet", "validation/week_03.parquet",
        "metadata/users_metadata.parquet", "metadata/items_metadata.parquet",
        "metadata/item_embeddings.npz", "notes.txt", ".cache/week_99.parquet",
    ])
    man = cat.manifest(cat.list_files(spark, root)).collect()
    by = {r["rel"]: r for r in man}
    assert by["metadata/item_embeddings.npz"]["category"] == "embeddings"  # before items
    assert by["metadata/users_metadata.parquet"]["category"] == "users"
    assert "notes.txt" not in by and ".cache/week_99.parquet" not in by
    inter = sorted((r["ord"], r["rel"]) for r in man if r["category"] == "interactions")
    # week order, not path order: 'test/week_26' sorts before 'train/week_00' by path
    assert [r for _, r in inter] == ["train/week_00.parquet", "validation/week_03.parquet",
                                     "test/week_26.parquet"]


def test_max_shards_and_no_embeddings(spark, tmp_path):
    root = str(tmp_path / "raw")
    _touch_tree(root, ["a/week_02.parquet", "a/week_01.parquet", "b/week_03.parquet",
                       "m/users.parquet", "m/items.parquet", "m/emb.npz"])
    src = Sources(max_shards=2, use_embeddings=False)
    man = cat.manifest(cat.list_files(spark, root, src), src).collect()
    rels = sorted(r["rel"] for r in man if r["category"] == "interactions")
    assert rels == ["a/week_01.parquet", "a/week_02.parquet"]
    assert not [r for r in man if r["category"] == "embeddings"]


def test_max_shards_keeps_whole_weeks_of_part_files(spark, tmp_path):
    root = str(tmp_path / "raw")
    _touch_tree(root, [f"log/week_{w:02d}.parquet/part-{p}.parquet" for w in range(3) for p in range(4)]
                + ["m/users.parquet", "m/items.parquet"])
    src = Sources(max_shards=2)
    man = cat.manifest(cat.list_files(spark, root, src), src).collect()
    kept = [r for r in man if r["category"] == "interactions"]
    assert len(kept) == 8
    assert {r["shard"] for r in kept} == {"log/week_00.parquet", "log/week_01.parquet"}


def test_row_index_under_a_root_with_a_quote(spark, tmp_path):
    root = str(tmp_path / "it's raw")
    spark.range(7).write.parquet(f"{root}/week_00.parquet")
    rows = sh.with_row_index(sh.scan(spark, [f"{root}/week_00.parquet"]), root).collect()
    assert sorted(r["event_order"] for r in rows) == list(range(7))


def test_missing_dir_and_missing_category(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        cat.list_files(spark, str(tmp_path / "nope"))
    root = str(tmp_path / "raw")
    _touch_tree(root, ["x/week_01.parquet"])
    with pytest.raises(ValueError):
        cat.validate(cat.manifest(cat.list_files(spark, root)))


def test_row_index_matches_time_order(spark):
    """S7 on the shard tree equals the source time order, with many files."""
    root = shard_tree.write_tree(spark, SF)
    man = cat.manifest(cat.list_files(spark, root))
    files = cat.paths(man, "interactions")
    assert len(files) >= 5
    log = sh.with_row_index(sh.scan(spark, files), root)
    ev = spark.read.parquet(f"{SF}/events.parquet").select(
        F.col("event_id").alias("event_order"), F.col("user_id").alias("u"),
        F.col("value").alias("t"))
    j = log.join(ev, "event_order")
    assert log.count() == ev.count() == j.count()
    assert j.where((F.col("u") != F.col("user_id")) | (F.col("t") != F.col("timespent"))).count() == 0
    # a pushed range filter does not change the numbering
    sub = log.where(F.col("event_order") >= 500).join(ev, "event_order")
    assert sub.where(F.col("u") != F.col("user_id")).count() == 0


def test_row_index_across_many_small_files(spark):
    path = scratch_path(spark, "many")
    spark.range(0, 5000).repartitionByRange(13, "id").write.parquet(f"{path}/week_01.parquet")
    spark.range(5000, 7000).repartitionByRange(4, "id").write.parquet(f"{path}/week_02.parquet")
    man = cat.manifest(cat.list_files(spark, path))
    log = sh.with_row_index(sh.scan(spark, cat.paths(man, "interactions")), path)
    assert log.where(F.col("id") != F.col("event_order")).count() == 0


def test_scan_meta_tolerant(spark):
    root = shard_tree.cached_tree(spark, SF)
    man = cat.manifest(cat.list_files(spark, root))
    df = sh.scan_meta(spark, cat.paths(man, "users"), ["user_id", "age", "absent"])
    assert df.columns == ["user_id", "age"]
    assert sh.scan_meta(spark, [], ["user_id"]) is None


def test_npz_roundtrip(spark):
    vec = spark.createDataFrame([(i, [float(i), 1.0, 2.0]) for i in range(50)],
                                "item_id long, embedding array<float>").repartition(3)
    folder = scratch_path(spark, "npz")
    assert emb.write_npz(vec, folder) == 50
    local = local_fs_path(folder)
    files = sorted(f"{folder}/{f}" for f in os.listdir(local) if f.endswith(".npz"))
    back = emb.read_npz(spark, files).collect()
    assert sorted(r["item_id"] for r in back) == list(range(50))
    assert all(np.isclose(r["embedding"][0], r["item_id"]) for r in back)


def test_parquet_vectors_fallback(spark):
    root = scratch_path(spark, "vecpq")
    spark.createDataFrame([(1, [1.0, 0.0])], "item_id long, embedding array<double>") \
        .write.parquet(f"{root}/items.parquet")
    v = emb.load_vectors(spark, [], [f"{root}/items.parquet"])
    assert v.first()["item_id"] == 1
    spark.createDataFrame([(1, 5)], "item_id long, duration long").write.parquet(f"{root}/plain.parquet")
    with pytest.warns(UserWarning):
        assert emb.read_parquet_vectors(spark, [f"{root}/plain.parquet"]) is None


@pytest.mark.parametrize("write", [np.savez, np.savez_compressed])
def test_one_archive_is_several_tasks(spark, tmp_path, write):
    """Row ranges of a stored archive; a compressed one is a single task of the same rows."""
    ids, x = np.arange(1000) * 7 - 50, np.random.default_rng(1).standard_normal((1000, 6))
    write(tmp_path / "a.npz", item_id=ids.astype(np.int32), embedding=x)
    np.savez(tmp_path / "none.npz", item_id=np.zeros(0, np.int64), embedding=np.zeros((0, 6), np.float32))
    df = npz.read(spark, [str(tmp_path / "a.npz"), str(tmp_path / "none.npz")], partition_bytes=10_000)
    assert df.rdd.getNumPartitions() == (5 if write is np.savez else 1)
    got = {r["item_id"]: r["embedding"] for r in df.collect()}
    assert sorted(got) == sorted(ids.tolist())
    assert all(np.array_equal(np.float32(got[int(i)]), np.float32(v)) for i, v in zip(ids, x, strict=True))
    assert npz.read(spark, []).count() == 0


def test_archive_slices_stay_small(tmp_path, monkeypatch):
    monkeypatch.setattr(npz, "SLICE_BYTES", 240)
    x = np.arange(600, dtype=np.float32).reshape(100, 6)
    np.savez(tmp_path / "a.npz", item_id=np.arange(100), embedding=x)
    parts = list(npz.NpzReader([str(tmp_path / "a.npz")], 1 << 20).read(npz.Rows(str(tmp_path / "a.npz"), 5, 98)))
    assert max(p.num_rows for p in parts) == 10 and sum(p.num_rows for p in parts) == 93
    assert parts[0].column(0)[0].as_py() == 5


def test_archives_that_are_not_read(tmp_path):
    np.savez(tmp_path / "f.npz", item_id=np.arange(3), embedding=np.asfortranarray(np.ones((3, 2))))
    np.savez(tmp_path / "n.npz", item_id=np.arange(2), embedding=np.ones((3, 2)))
    for name, why in (("f", "column order"), ("n", "belong")):
        with pytest.raises(ValueError, match=why):
            npz.NpzReader([str(tmp_path / f"{name}.npz")], 100).partitions()
