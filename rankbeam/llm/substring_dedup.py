"""Repeated passages found by difference-cover anchors (operator 11).

A passage is a window of ``width`` words. Positions whose remainder modulo 7 is
1, 2 or 4 form a difference cover: for any shift of two positions some step of
0 to 6 words brings both onto cover positions. So two equal windows, wherever
they start, hold an equal *anchor* (``width`` - 6 words from a cover position)
at the same place inside both, and only 3 of 7 positions have to be indexed.

1. Documents are dealt into blocks of a few megabytes; every block sends the
   hashes of its anchors, each once, to buckets.
2. A bucket tells each block which of its anchors another block holds too.
3. Every block extends its shared anchors to the up to 7 windows around each
   and sends the windows' hashes with the smallest doc_id that has them.
4. A bucket tells each block which of its windows also start in a document
   with a smaller doc_id; the block removes the words these windows cover.

A passage that very many documents share costs one entry a block, not one a
document, and no pair of documents is ever formed. Buckets grow in number with
the text, so a bucket's arrays stay within a few million entries. Anchors only
propose windows: a false agreement of two anchor hashes costs time alone.
Windows are told apart by 64 bits.

Edge cases: a null text has no words, an empty or blank one neither (0 words,
empty ``kept``); a text with fewer words than ``width`` has no window and stays
whole; words are compared by their UTF-8 bytes, unchanged. A document without
doc_id takes no part: nothing is removed from it or because of it. Rows that
repeat a doc_id are one document for the comparison, so they do not remove
each other's words; each is returned. Repeats inside one document stay. Texts
of any length are read whole. An empty table gives an empty result. Only
``doc_id`` and ``text`` are read; other columns of any name are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, slices, text_buffers
from .shingles import mix, window_hashes, word_hashes

WIDTH = 13
# The difference cover {1, 2, 4} modulo 7.
PERIOD, COVER = 7, (1, 2, 4)
#: Text of a block, text whose anchors and windows share a bucket, in bytes; least buckets.
BLOCK_BYTES, BUCKET_BYTES, LEAST_BUCKETS = 2 << 20, 128 << 20, 24

_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                    ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    ("kept", pa.string())])
_U = np.uint64
_ALL = np.iinfo(np.int64).min  # smaller than any document: the window goes everywhere


class Block:
    """Words of a block's documents and their windows."""

    def __init__(self, docs: pa.Table, width: int):
        self.width = width
        hashes, owner, at = [], [], 0
        for part in slices(docs.select(["doc_id", "text"]).combine_chunks().to_batches(), "text", 1 << 20):
            raw, off, _ = text_buffers(part.column(1))
            h, doc = word_hashes(raw, off, fold=False)
            hashes.append(h)
            owner.append(doc + at)
            at += part.num_rows
        self.h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        ids = docs.column("doc_id").combine_chunks()
        known = np.asarray(ids.is_valid())
        self.n_words = np.bincount(owner, minlength=docs.num_rows)
        ends = np.cumsum(self.n_words)
        self.left = ends[owner] - np.arange(len(owner))  # words from here to the document's end
        self.place = self.n_words[owner] - self.left  # number of the word in its document
        self.known = known[owner]
        self.doc = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[owner]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the anchors: windows that start at cover positions."""
        w = self.width - PERIOD + 1
        at = np.flatnonzero(np.isin(self.place % PERIOD, COVER) & (self.left >= w) & self.known)
        return at, window_hashes(self.h, w)[at]

    def around(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of the whole windows that hold one of these anchors within their first words."""
        hit = np.zeros(len(self.h), bool)
        for back in range(PERIOD):
            hit[anchors[self.place[anchors] >= back] - back] = True
        return np.flatnonzero(hit & (self.left >= self.width))

    def windows(self) -> np.ndarray:
        return window_hashes(self.h, self.width, seed=1)


def _several(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the smallest document of each, and whether it has a second one."""
    order = np.lexsort((doc, keys))
    keys, doc = keys[order], doc[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    last = np.r_[first[1:], len(keys)] - 1
    return keys[first], doc[first], doc[last] != doc[first] if len(first) else np.zeros(0, bool)


def _dealt(bucket: np.ndarray, *columns: np.ndarray):
    """(bucket, its part of every column) of each bucket that has entries."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else []
    for s, e in itertools.pairwise([*cuts, len(b)]):
        yield int(b[s]), *(c[order[s:e]] for c in columns)


def _packed(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    """Rows whose arrays become bytes."""
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.table([pa.array([v.tobytes() if isinstance(v, np.ndarray) else v for v in c], f.type)
                     for c, f in zip(columns, schema, strict=True)], schema=schema)


def _joined(col: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """All entries of byte columns, and the row each came from."""
    parts = [np.frombuffer(v, kind) for v in col.to_pylist()]
    sizes = [len(p) for p in parts]
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), np.repeat(np.arange(len(parts)), sizes)


_SENT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("low", pa.binary())])
_SHARED = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("low", pa.binary())])
_WINDOWS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("key", pa.binary()),
                      ("doc", pa.binary()), ("twice", pa.binary())])
_GONE = pa.schema([("block", pa.int64()), ("key", pa.binary()), ("above", pa.binary())])


def _split_hash(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A bucket from the upper half of a hash, the lower half as the key in it."""
    return ((h >> _U(32)) % _U(buckets)).astype(np.int64), h.astype(np.uint32)


def _send_anchors(width: int, buckets: int):
    def fn(docs: pa.Table) -> pa.Table:
        block = docs.column("block")[0].as_py()
        bucket, low = _split_hash(np.unique(Block(docs, width).anchors()[1]), buckets)
        return _packed([(b, block, part) for b, part in _dealt(bucket, low)], _SENT)
    return fn


def _shared_anchors(sent: pa.Table) -> pa.Table:
    """For each block of a bucket the anchors that another block sent too."""
    low, row = _joined(sent.column("low"), np.uint32)
    order = np.argsort(low, kind="stable")
    same = low[order[1:]] == low[order[:-1]]
    both = np.zeros(len(low), bool)
    both[order[1:][same]] = True
    both[order[:-1][same]] = True
    low, row = low[both], row[both]
    bucket, block = sent.column("bucket")[0].as_py(), sent.column("block").to_pylist()
    return _packed([(block[r], bucket, part) for r, part in _dealt(row, low)], _SHARED)


def _send_windows(width: int, buckets: int):
    def fn(docs: pa.Table, shared: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return _packed([], _WINDOWS)
        block = Block(docs, width)
        at, h = block.anchors()
        bucket, low = _split_hash(h, buckets)
        codes = (bucket.astype(np.uint64) << _U(32)) | low
        there, row = _joined(shared.column("low"), np.uint32)
        of = shared.column("bucket").combine_chunks().to_numpy().astype(np.uint64)
        there = (of[row] << _U(32)) | there
        # Within the block: anchors of two documents.
        key, _, twice = _several(h, block.doc[at])
        starts = block.around(at[np.isin(codes, there) | np.isin(h, key[twice])])
        key, doc, twice = _several(block.windows()[starts], block.doc[starts])
        to = (mix(key) % _U(buckets)).astype(np.int64)
        number = docs.column("block")[0].as_py()
        return _packed([(b, number, k, d, t) for b, k, d, t in _dealt(to, key, doc, twice)], _WINDOWS)
    return fn


def _repeated_windows(sent: pa.Table) -> pa.Table:
    """For each block of a bucket its windows that start in a smaller document too,
    with the document above which they go."""
    key, row = _joined(sent.column("key"), np.uint64)
    doc, _ = _joined(sent.column("doc"), np.int64)
    twice, _ = _joined(sent.column("twice"), np.bool_)
    order = np.lexsort((doc, key))
    first = np.r_[True, key[order[1:]] != key[order[:-1]]]
    lowest = np.empty(len(key), np.int64)
    lowest[order] = doc[order[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]]
    later = doc > lowest
    goes = later | twice
    above = np.where(later, _ALL, lowest)
    block = sent.column("block").to_pylist()
    return _packed([(block[r], k, a) for r, k, a in _dealt(row[goes], key[goes], above[goes])], _GONE)


def _remove(width: int):
    def fn(docs: pa.Table, gone: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return _FOUND.empty_table()
        block = Block(docs, width)
        key, _ = _joined(gone.column("key"), np.uint64)
        above, _ = _joined(gone.column("above"), np.int64)
        covered = np.zeros(len(block.h) + 1, np.int64)
        h = block.windows()
        if len(key) and len(h):
            order = np.argsort(key)
            key, above = key[order], above[order]
            spot = np.minimum(np.searchsorted(key, h), len(key) - 1)
            n = len(h)
            hit = np.flatnonzero((key[spot] == h) & (block.left[:n] >= width) & block.known[:n]
                                 & (block.doc[:n] > above[spot]))
            covered[hit] += 1
            covered[hit + width] -= 1
        drop = np.cumsum(covered)[:-1] > 0
        ends = np.cumsum(block.n_words)
        # Spans: where dropping starts and ends, documents apart.
        fresh = np.r_[True, block.place[1:] == 0] if len(drop) else drop
        start = np.flatnonzero(drop & (fresh | ~np.r_[False, drop[:-1]]))
        end = np.flatnonzero(drop & np.r_[fresh[1:] | ~drop[1:], True]) if len(drop) else start
        owner = np.searchsorted(ends, start, "right")
        base = (ends - block.n_words)[owner]
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(start, np.r_[0, ends]).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(start - base), pa.array(end + 1 - base)], ["start", "end"]))
        totals = np.r_[0, np.cumsum(drop)]
        removed = totals[ends] - totals[ends - block.n_words]
        kept = []
        for text, e, n, r in zip(docs.column("text").cast(pa.binary()).to_pylist(), ends.tolist(),
                                 block.n_words.tolist(), removed.tolist(), strict=True):
            words = (text or b"").split()
            if r:
                words = itertools.compress(words, (~drop[e - n:e]).tolist())
            kept.append(b" ".join(words))
        return pa.table([docs.column("doc_id"), pa.array(block.n_words), pa.array(removed), spans,
                         pa.array(kept, pa.binary()).cast(pa.string())], schema=_FOUND)
    return fn


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, removed (word spans), kept (the other words, one space
    between two): words covered by a ``width``-word window that also starts in a document
    with a smaller doc_id are removed. Two scans: one adds the bytes up, one deals blocks."""
    if width < PERIOD + 2:
        raise ValueError(f"width must be at least {PERIOD + 2}")
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = max(1, -(-total // BLOCK_BYTES)), max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))
    block = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(blocks))
    # One exchange of the texts that all three passes over the blocks reuse.
    dealt = docs.select(block.alias("block"), "doc_id", "text").repartition("block")
    sent = dealt.groupBy("block").applyInArrow(
        _send_anchors(width, buckets), "bucket long, block long, low binary")
    shared = sent.groupBy("bucket").applyInArrow(_shared_anchors, "block long, bucket long, low binary")
    windows = dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        _send_windows(width, buckets), "bucket long, block long, key binary, doc binary, twice binary")
    gone = windows.groupBy("bucket").applyInArrow(
        _repeated_windows, "block long, key binary, above binary")
    return dealt.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(
        _remove(width), "doc_id long, n_words long, n_removed long, "
                        "removed array<struct<start: long, end: long>>, kept string")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts, and the sha256 of the kept words."""
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256)
                        .alias("kept_sha256"))
