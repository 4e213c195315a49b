"""Session helpers: a local session for tests/bench and the shared scratch dir."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rankbeam", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset and
    the master is local (tests) a folder under the system temp dir is chosen. A
    machine-local folder on a cluster would give tables that no other machine
    sees, so there the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="rankbeam-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "rankbeam", f"{name}-{uuid.uuid4().hex[:12]}")


def fs_and_path(uri: str):
    """A pyarrow filesystem for ``uri`` (file, hdfs, s3, ...) and the path in it."""
    from pyarrow import fs as pafs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rankbeam`` importable by every Python worker (once per application).

    The functions given to ``mapInPandas`` live in this package, so executors
    must import it. The package's sources are zipped into the shared
    checkpoint folder and registered with ``SparkContext.addPyFile``, which is
    what ``spark-submit --py-files`` does at launch.
    """
    import io
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_root)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, base))
    target = scratch_path(spark, "pyfiles") + "/rankbeam.zip"
    fs, path = fs_and_path(target)
    fs.create_dir(os.path.dirname(path), recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(key)


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can use the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path
