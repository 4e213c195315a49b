"""Importance resampling towards a target distribution (operator 13).

Features of a text are its runs of 1 to ``max_n`` consecutive words, hashed to
``buckets`` by crc32. A bucket's gain is the log ratio of its smoothed share in
the target texts and in the documents; a document's weight is the sum of the
gains of its features, looked up in one array. Adding Gumbel noise, which the
doc_id fixes, and taking the highest scores draws without replacement in
proportion to the weights.

The cutoff is found without sorting the scores: a quantile sketch proposes a
bracket of score values around it, exact counts of what lies above and inside
say whether the cutoff is inside, and the bracket is widened until it is. While
the bracket holds too many rows it is cut again by a sketch of its own rows,
and by doc_id once it is a single score; only the last, small bracket is
sorted. The drawn rows alone are then ranged and numbered.

Edge cases: words are runs of bytes other than 0x00-0x2F, 0x3A-0x60 and
0x7B-0x7F after A-Z became a-z, in whole texts of any length. A null, empty or
wordless text has no features, weight 0 and is scored, but with fewer words
than ``min_words`` it is never drawn. A row without doc_id has no score, is not
among the documents that the drawn share counts, and is never drawn; its words
do count in the distribution. Ties go to the smaller doc_id; rows that repeat a
doc_id are ordered by their weight and feature count, and equal rows are
interchangeable. Empty documents give an empty result, empty target texts a
uniform target. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, slices, text_buffers, written

#: A bracket of at most so many rows is sorted; a sketch's accuracy; words remembered a worker.
SORTED_ROWS, ACCURACY, MEMORY = 50_000, 10_000, 200_000

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


class _Buckets(dict):
    """Bucket of a feature, remembered while it fits the memory."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        self[feature] = b = crc32(feature) % self.buckets
        return b


def _features(batches: Iterator[pa.RecordBatch], column: str, max_n: int,
              buckets: int) -> Iterator[tuple[pa.RecordBatch, list[int], np.ndarray, np.ndarray]]:
    """For slices of the rows: words of each, features of each, buckets of all features."""
    known = _Buckets(buckets)
    for batch in slices(batches, column):
        raw, off, _ = text_buffers(batch.column(batch.schema.get_field_index(column)))
        data = raw.tobytes().translate(_TABLE)
        n_words, n_features, found = [], [], []
        for a, b in itertools.pairwise(off.tolist()):
            words = data[a:b].split()
            count = 0
            for n in range(1, max_n + 1):
                runs = words if n == 1 else map(b" ".join, zip(*(words[k:] for k in range(n))))
                got = np.fromiter(map(known.__getitem__, runs), np.int32)
                found.append(got)
                count += len(got)
            n_words.append(len(words))
            n_features.append(count)
        yield (batch, n_words, np.array(n_features),
               np.concatenate(found) if found else np.zeros(0, np.int32))


def _count(max_n: int, buckets: int):
    def fn(batches):
        total = np.zeros(buckets, np.int64)
        for _, _, _, found in _features(batches, "text", max_n, buckets):
            total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])
    return fn


def feature_counts(texts: DataFrame, max_n: int, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket; at most one row a bucket leaves a task."""
    rows = texts.select("text").mapInArrow(_count(max_n, buckets), "bucket long, n long")
    table = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


@dataclass(frozen=True)
class Model:
    gains: np.ndarray  # thousandths of a log ratio, by bucket
    max_n: int


def fit(docs: DataFrame, target: DataFrame, buckets: int = 10_000, max_n: int = 1) -> Model:
    """Gains from the counts over all documents and all target texts."""
    prepare(docs.sparkSession)
    s, t = (feature_counts(x, max_n, buckets) for x in (docs, target))
    ratio = ((t + 1) * (int(s.sum()) + buckets)) / ((s + 1) * (int(t.sum()) + buckets))
    return Model(np.floor(1000 * np.log(ratio)).astype(np.int64), max_n)


def _weigh(model: Model):
    def fn(batches):
        for batch, n_words, n_features, found in _features(batches, "text", model.max_n, len(model.gains)):
            sums = np.r_[0, np.cumsum(model.gains[found])]
            ends = np.cumsum(n_features)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_features),
                 pa.array(sums[ends] - sums[ends - n_features])],
                ["doc_id", "n_words", "n_features", "weight"])
    return fn


def weigh(docs: DataFrame, model: Model, seed: int = 2024) -> DataFrame:
    """doc_id, n_words, n_features, weight and score (null without doc_id) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _weigh(model), "doc_id long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"),
                                  256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + noise.cast("long"))


@dataclass(frozen=True)
class Cutoff:
    """The last drawn row's place: rows before it in the order are drawn."""

    score: int
    doc_id: int
    rounds: int


def _bracket(rows: DataFrame, key: Column, k: int, n: int) -> tuple[int, int, int]:
    """(low, high, rows above high) of a range of key values that holds the k-th highest of
    the n keys; counts outside it are exact and widen it until it does."""
    at, slack = 1 - (k - 0.5) / n, 2 / ACCURACY
    while True:
        wanted = [max(0.0, at - slack), min(1.0, at + slack)]
        low, high = rows.select(F.percentile_approx(key, wanted, ACCURACY)).first()[0]
        above, inside = rows.agg(F.count_if(key > high), F.count_if((key <= high) & (key >= low))).first()
        if above < k <= above + inside:
            return low, high, above
        slack *= 4  # the sketch missed: ends at the least and the greatest key


def find_cutoff(rows: DataFrame, k: int) -> Cutoff | None:
    """The place of the k-th row by score, highest first, then doc_id; None for k = 0. ``rows``
    (doc_id, score, neither null) is read several times."""
    n = rows.count()
    if k <= 0 or n == 0:
        return None
    k, rounds = min(k, n), 0
    for key in (F.col("score"), -F.col("doc_id")):
        while n > SORTED_ROWS:
            low, high, above = _bracket(rows, key, k, n)
            rows = rows.where((key >= low) & (key <= high))
            before, n, k, rounds = n, rows.count(), k - above, rounds + 1
            if low == high:
                break
            if n == before:  # a few key values: try each end, then what is between them
                top = rows.where(key == high).count()
                rows, n, k = (rows.where(key == high), top, k) if k <= top else (
                    rows.where(key < high), n - top, k - top)
    if n > SORTED_ROWS:  # rows of one doc_id and score
        last = rows.first()
    else:
        table = rows.select("score", "doc_id").toArrow()
        score, ids = (table.column(c).to_numpy() for c in ("score", "doc_id"))
        spot = np.lexsort((ids, -score))[k - 1]
        return Cutoff(int(score[spot]), int(ids[spot]), rounds)
    return Cutoff(last["score"], last["doc_id"], rounds)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, buckets: int = 10_000,
             max_n: int = 1, seed: int = 2024) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document; the rank, from 1,
    is null unless the document is among the drawn ``percent`` of those with ``min_words``."""
    spark = prepare(docs.sparkSession)
    scored = written(weigh(docs, fit(docs, target, buckets, max_n), seed), "resampling-scored")
    able = scored.where((F.col("n_words") >= min_words) & F.col("doc_id").isNotNull())
    k = percent * able.count() // 100
    cut = find_cutoff(able.select("doc_id", "score"), k)
    none = F.lit(None).cast("long")
    if cut is None:
        return scored.withColumn("rank", none)
    order = [F.desc("score"), F.asc("doc_id"), F.desc("weight"), F.desc("n_features"), F.desc("n_words")]
    is_able = (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()
    drawn = F.coalesce(is_able & ((F.col("score") > cut.score) | (
        (F.col("score") == cut.score) & (F.col("doc_id") <= cut.doc_id))), F.lit(False))
    # Ranged once and written, so the parts' numbers stay what they are.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(scored.where(drawn).repartitionByRange(parts, *order)
                     .withColumn("_part", F.spark_partition_id()), "resampling-drawn")
    sizes = ranged.groupBy("_part").count().withColumn("_before", F.sum("count").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))  # one row a part
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    ranked = ranged.withColumn("rank", within).join(F.broadcast(sizes), "_part").select(
        *scored.columns, (F.col("rank") + F.coalesce("_before", F.lit(0))).cast("long").alias("rank"))
    # Rows that repeat the last drawn doc_id may pass the share: the surplus is not drawn.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return ranked.unionByName(scored.where(~drawn).withColumn("rank", none))
