"""Vectors of NPZ archives as a Spark data source.

An archive is a zip of ``.npy`` members, here ``item_id`` and ``embedding``. The
reader plans from the zip directory and the array headers alone. Stored members
(``numpy.savez``) hold rows at fixed offsets, so a partition is a range of rows
that its task reads by seeking; a large archive is many tasks. Compressed
members have to be read from their start, so such an archive is one task. Either
way a task holds one slice of a few megabytes, and no archive size is too large.
"""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import fs_and_path, ship_package

FORMAT = "npz_vectors"
SCHEMA = "item_id long, embedding array<float>"
#: Bytes of vectors in a partition and in the slice that a task holds.
PARTITION_BYTES, SLICE_BYTES = 64 << 20, 4 << 20
_LOCAL_HEADER = 30  # fixed part of a zip member's own header


@dataclass
class Rows(InputPartition):
    """Rows [start, end) of one archive."""

    path: str
    start: int
    end: int

    def __post_init__(self):
        super().__init__((self.path, self.start, self.end))


class Member:
    """One array of an archive: its header, and its rows by slices."""

    def __init__(self, source, archive: zipfile.ZipFile, name: str):
        self.source, self.archive = source, archive
        self.info = archive.getinfo(f"{name}.npy")
        with archive.open(self.info) as f:
            version = np.lib.format.read_magic(f)
            read = (np.lib.format.read_array_header_1_0 if version == (1, 0)
                    else np.lib.format.read_array_header_2_0)
            self.shape, fortran, self.dtype = read(f)
            self.header = f.tell()
        if fortran and len(self.shape) > 1 and min(self.shape) > 1:
            raise ValueError(f"{name}: arrays in column order are not read")
        if self.dtype.hasobject:
            raise ValueError(f"{name}: arrays of objects are not read")
        self.width = int(np.prod(self.shape[1:], dtype=np.int64))

    @property
    def stored(self) -> bool:
        return self.info.compress_type == zipfile.ZIP_STORED

    def slices(self, start: int, end: int, rows: int) -> Iterator[np.ndarray]:
        """Rows [start, end) in parts of at most ``rows``."""
        row = self.width * self.dtype.itemsize
        if self.stored:
            self.source.seek(self.info.header_offset)
            fixed = self.source.read(_LOCAL_HEADER)
            # The lengths of name and extra field stand at 26 and 28.
            at = self.info.header_offset + _LOCAL_HEADER + sum(
                int.from_bytes(fixed[k:k + 2], "little") for k in (26, 28)) + self.header
            for lo in range(start, end, rows):
                hi = min(end, lo + rows)
                self.source.seek(at + lo * row)
                yield self._array(self.source.read((hi - lo) * row))
            return
        with self.archive.open(self.info) as f:
            f.seek(self.header + start * row)
            for lo in range(start, end, rows):
                yield self._array(f.read((min(end, lo + rows) - lo) * row))

    def _array(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, self.dtype).reshape(-1, *self.shape[1:])


def _members(path: str):
    fs, inner = fs_and_path(path)
    source = fs.open_input_file(inner)
    archive = zipfile.ZipFile(source)
    # Each array seeks on its own handle.
    ids = Member(source, archive, "item_id")
    vectors = Member(fs.open_input_file(inner), archive, "embedding")
    if len(ids.shape) != 1 or len(vectors.shape) != 2 or ids.shape[0] != vectors.shape[0]:
        raise ValueError(f"{path}: item_id {ids.shape} and embedding {vectors.shape} do not belong together")
    return ids, vectors


class NpzReader(DataSourceReader):
    def __init__(self, paths: list[str], partition_bytes: int):
        self.paths, self.partition_bytes = paths, partition_bytes

    def partitions(self) -> Sequence[Rows]:
        out = []
        for path in self.paths:
            ids, vectors = _members(path)
            n = ids.shape[0]
            per = n
            if ids.stored and vectors.stored:
                per = max(1, self.partition_bytes // max(1, vectors.width * vectors.dtype.itemsize))
            out += [Rows(path, lo, min(n, lo + per)) for lo in range(0, n, max(1, per))]
        return out or [Rows("", 0, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        ids, vectors = _members(partition.path)
        rows = max(1, SLICE_BYTES // max(1, 4 * vectors.width))
        for a, b in zip(ids.slices(partition.start, partition.end, rows),
                        vectors.slices(partition.start, partition.end, rows), strict=True):
            flat = pa.array(np.ascontiguousarray(b, np.float32).ravel())
            offsets = pa.array(np.arange(len(a) + 1, dtype=np.int32) * vectors.width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.astype(np.int64)), pa.ListArray.from_arrays(offsets, flat)], ["item_id", "embedding"])


class NpzSource(DataSource):
    """``spark.read.format("npz_vectors").option("paths", json list).load()``"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> NpzReader:
        return NpzReader(json.loads(self.options["paths"]),
                         int(self.options.get("partitionBytes", PARTITION_BYTES)))


def read(spark: SparkSession, files: list[str], partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(item_id, embedding) of all archives."""
    ship_package(spark)
    spark.dataSource.register(NpzSource)
    return (spark.read.format(FORMAT).option("paths", json.dumps(list(files)))
            .option("partitionBytes", str(partition_bytes)).load())
