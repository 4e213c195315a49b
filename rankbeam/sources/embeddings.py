"""Item vectors from NPZ archives or Parquet list columns.

NPZ archives are read by row ranges on the executors (``npz``, a Spark data
source), never on the driver. Where only Spark can open the files (a scheme
that ``pyarrow.fs`` does not know), each is one ``binaryFile`` row of at most
2 GB instead.
"""

from __future__ import annotations

import io
import warnings

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fs_and_path, ship_package
from . import npz

VEC_SCHEMA = "item_id long, embedding array<float>"


def _decode_npz(batches):
    for pdf in batches:
        for content in pdf["content"]:
            with np.load(io.BytesIO(bytes(content)), allow_pickle=False) as z:
                ids = np.asarray(z["item_id"], dtype=np.int64)
                emb = np.asarray(z["embedding"], dtype=np.float32)
            yield pd.DataFrame({"item_id": ids, "embedding": list(emb)})


def read_npz(spark: SparkSession, files: list[str]) -> DataFrame:
    """Arrays ``item_id`` and ``embedding`` of every file, concatenated."""
    try:
        for f in files:
            fs_and_path(f)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        ship_package(spark)
        raw = spark.read.format("binaryFile").load(files)
        return raw.select("content").mapInPandas(_decode_npz, VEC_SCHEMA)
    return npz.read(spark, files)


def read_parquet_vectors(spark: SparkSession, files: list[str], id_col: str = "item_id",
                         emb_col: str = "embedding") -> DataFrame | None:
    """List-column vectors; warn and return None if the column is absent."""
    df = spark.read.parquet(*sorted(files))
    if emb_col not in df.columns:
        warnings.warn(f"column {emb_col!r} not found in the vector files")
        return None
    return df.select(F.col(id_col).alias("item_id"),
                     F.col(emb_col).cast("array<float>").alias("embedding"))


def load_vectors(spark: SparkSession, emb_files: list[str], item_files: list[str],
                 id_col: str = "item_id", emb_col: str = "embedding") -> DataFrame | None:
    """Vectors from the embedding files, else from item metadata files (S10 fallback)."""
    files = emb_files or item_files
    if not files:
        return None
    npz = [f for f in files if f.endswith(".npz")]
    if npz:
        return read_npz(spark, sorted(npz))
    return read_parquet_vectors(spark, files, id_col, emb_col)


def _write_npz_partition(folder: str):
    def fn(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        ids, embs = [], []
        for pdf in batches:
            ids.append(pdf["item_id"].to_numpy(dtype=np.int64))
            embs.extend(pdf["embedding"].tolist())
        if not ids:
            return
        ids_arr = np.concatenate(ids)
        emb_arr = np.asarray([np.asarray(e, dtype=np.float32) for e in embs], dtype=np.float32)
        buf = io.BytesIO()
        np.savez(buf, item_id=ids_arr, embedding=emb_arr)
        fs, base = fs_and_path(folder)
        fs.create_dir(base, recursive=True)
        path = f"{base.rstrip('/')}/part-{pid:05d}.npz"
        with fs.open_output_stream(path) as out:
            out.write(buf.getvalue())
        yield pd.DataFrame({"path": [path], "n": [len(ids_arr)]})
    return fn


def write_npz(vectors: DataFrame, folder: str) -> int:
    """Write (item_id, embedding) as one NPZ file per partition, from the executors.

    ``folder`` is a URI on storage every executor reaches (the shared folder);
    files go through ``pyarrow.fs``, so local, HDFS and object stores work.
    """
    ship_package(vectors.sparkSession)
    out = vectors.select("item_id", "embedding").mapInPandas(
        _write_npz_partition(folder), "path string, n long")
    return int(out.agg(F.sum("n")).first()[0] or 0)
