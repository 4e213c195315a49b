"""Periodic runs in word sequences by internal pattern matching (operator 12).

A run is a stretch of words with smallest period q, at least ``max(min_length,
min_periods * q)`` words long, that no neighbouring word extends.

Blocks of 2^k words at multiples of 2^k are the patterns. For 2^k <= q < 2^(k+1)
a run of three periods holds such a block together with its copy q words
later, so the copy is among the block's occurrences that start 2^k to 2^(k+1) - 1
words after it; periods below the smallest block length are the distance to its
next occurrence. Occurrences of a block are one interval of the suffix array,
and those in a window are found by range successor on a wavelet tree over it.

* One or two occurrences: their distances are the candidate periods.
* Three or more form an arithmetic progression whose difference p is the
  block's own period. Then the block and the progression lie in two stretches
  of period p, and a run maps the ends of one onto the ends of the other: the
  distances between their right ends and between their left ends are the only
  candidates.

Candidates are extended in both directions by comparing blocks of falling
length, which gives the exact run; of equal stretches the smallest period stays.

Suffixes are sorted by prefix doubling from the smallest block length, each
document by itself; positions whose block occurs once drop out at once. All
documents of about a megabyte of text are handled by the same array operations,
so memory is bounded by that or by one document. No shuffle.

Edge cases: a null, empty or blank text has no words, no runs and an empty
``collapsed``; a text shorter than ``min_length`` words has no run. Words are
compared by their UTF-8 bytes through 64-bit hashes. Texts of any length are
read whole; rows with a null or repeated doc_id are handled like all others;
an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, slices, text_buffers
from .shingles import mix, window_hashes, word_hashes

MIN_LENGTH, MIN_PERIODS = 24, 3

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)),
                    ("collapsed", pa.string())])


class WaveletTree:
    """Order statistics of any interval of an integer sequence, for many intervals at once."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(self.n).bit_length())
        self.zeros = []  # per bit, from the highest: zeros before each place
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1
            self.zeros.append(np.r_[0, np.cumsum(1 - one)])
            values = np.r_[values[one == 0], values[one == 1]]

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [lo, hi) are less than x."""
        lo, hi, out = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        over = x >= 1 << self.bits
        out[over] = (hi - lo)[over]
        for level, z in enumerate(self.zeros):
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            zl, zh = z[lo], z[hi]
            out += np.where(one & ~over, zh - zl, 0)
            lo = np.where(one, z[-1] + lo - zl, zl)
            hi = np.where(one, z[-1] + hi - zh, zh)
        return out

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) of [lo, hi)."""
        lo, hi, k, out = lo.copy(), hi.copy(), k.copy(), np.zeros(len(lo), np.int64)
        for level, z in enumerate(self.zeros):
            zl, zh = z[lo], z[hi]
            one = k >= zh - zl
            k = np.where(one, k - (zh - zl), k)
            out += one.astype(np.int64) << (self.bits - 1 - level)
            lo = np.where(one, z[-1] + lo - zl, zl)
            hi = np.where(one, z[-1] + hi - zh, zh)
        return out


class Suffixes:
    """Suffix array of the repeated blocks of some documents, and the block classes by length."""

    def __init__(self, words: np.ndarray, doc: np.ndarray, left: np.ndarray, base: int):
        n = len(words)
        self.words, self.doc, self.left, self.n = words, doc, left, n
        self.lengths, self.ranks, self.starts = [], [], []
        h = np.zeros(n, np.uint64)
        whole = window_hashes(words, base)
        h[:len(whole)] = whole
        with np.errstate(over="ignore"):
            h = mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at = np.flatnonzero(left >= base)
        at = at[np.argsort(h[at], kind="stable")]
        first = self._firsts(h[at])
        sizes = np.diff(np.r_[first, len(at)])
        self.at = at[np.repeat(sizes > 1, sizes)]  # suffixes whose first block occurs again
        sizes = sizes[sizes > 1]
        rank = n + np.arange(n)  # classes of blocks that occur once: none alike
        first = np.cumsum(sizes) - sizes
        rank[self.at] = np.repeat(first, sizes)
        length = base
        while len(first):
            self.lengths.append(length)
            self.ranks.append(rank)
            self.starts.append(np.r_[first, len(self.at)])
            rank, first = self._doubled(rank, length)
            length *= 2

    @staticmethod
    def _firsts(keys: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)

    def _doubled(self, rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Sort classes of ``length`` words by the next ``length`` words."""
        slot = np.flatnonzero(rank[self.at] < self.n)
        at = self.at[slot]
        after = at + length
        follow = np.where(after < self.n, rank[np.minimum(after, self.n - 1)], 2 * self.n + at)
        order = np.lexsort((follow, rank[at]))
        at, follow = at[order], follow[order]
        self.at[slot] = at
        old = rank[at]
        fresh = np.r_[True, (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])] if len(at) else old > 0
        first = np.flatnonzero(fresh)
        sizes = np.diff(np.r_[first, len(at)])
        out = rank.copy()
        many = np.repeat(sizes > 1, sizes)
        out[at[many]] = np.repeat(slot[first], sizes)[many]
        out[at[~many]] = self.n + at[~many]
        return out, slot[first[sizes > 1]]

    def interval(self, level: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the suffixes that begin with a class of blocks stand in the suffix array."""
        size = np.zeros(len(self.at) + 1, np.int64)
        active = self.ranks[level][self.at]
        active = active[active < self.n]
        np.add.at(size, active, 1)
        return rank, rank + size[rank]

    def extend(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """Words that agree from i and j (i < j, one document) on, forwards (step 1, i and j
        included) or backwards (step -1, i and j left out)."""
        got = np.zeros(len(i), np.int64)
        behind = self.n_before
        top = len(self.lengths) - 1
        for level in range(top, -1, -1):
            m, rank = self.lengths[level], self.ranks[level]
            go = np.arange(len(i))
            while len(go):
                a, b = (i[go] + got[go], j[go] + got[go]) if step > 0 else (i[go] - got[go] - m, j[go] - got[go] - m)
                inside = (b < self.n) if step > 0 else (behind[i[go]] - got[go] >= m)
                go, a, b = go[inside], a[inside], b[inside]
                go = go[rank[a] == rank[b]]
                got[go] += m
                if level < top:
                    break
        go = np.arange(len(i))
        while len(go):  # less than a block is left
            a, b = (i[go] + got[go], j[go] + got[go]) if step > 0 else (i[go] - got[go] - 1, j[go] - got[go] - 1)
            inside = (got[go] < self.left[j[go]]) if step > 0 else (got[go] < behind[i[go]])
            go, a, b = go[inside], a[inside], b[inside]
            go = go[self.words[a] == self.words[b]]
            got[go] += 1
        return got

    @property
    def n_before(self) -> np.ndarray:
        """Words of the document before each position."""
        if not hasattr(self, "_before"):
            first = np.flatnonzero(np.r_[True, self.doc[1:] != self.doc[:-1]])
            self._before = np.arange(self.n) - np.repeat(first, np.diff(np.r_[first, self.n]))
        return self._before


def _candidates(s: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) pairs that every run has one of."""
    order = np.sort(s.at)  # the tree holds places among the repeated suffixes
    tree = WaveletTree(np.searchsorted(order, s.at))
    where, period = [], []

    def in_window(level, rank, low, high):
        """How many occurrences start in [low, high), and a way to the k-th of them."""
        lo, hi = s.interval(level, rank)
        skip = tree.below(lo, hi, np.searchsorted(order, low))
        count = tree.below(lo, hi, np.searchsorted(order, high)) - skip
        return count, lambda rows, k: order[tree.kth(lo[rows], hi[rows], skip[rows] + k)]

    for level, m in enumerate(s.lengths):
        rank = s.ranks[level]
        i = np.arange(0, s.n, m)
        i = i[rank[i] < s.n]
        if level == 0:  # periods up to the block length: the next occurrence
            count, get = in_window(level, rank[i], i + 1, i + m + 1)
            rows = np.flatnonzero(count > 0)
            where.append(i[rows])
            period.append(get(rows, np.zeros(len(rows), np.int64)) - i[rows])
        count, get = in_window(level, rank[i], i + m, i + 2 * m)
        for k in (0, 1):
            rows = np.flatnonzero((count > k) & (count < 3))
            where.append(i[rows])
            period.append(get(rows, np.full(len(rows), k)) - i[rows])
        rows = np.flatnonzero(count >= 3)
        at, one, two = i[rows], get(rows, np.zeros(len(rows), np.int64)), get(rows, np.ones(len(rows), np.int64))
        p = two - one
        right = (one + s.extend(one, two, 1)) - (at + s.extend(at, at + p, 1))
        left = (one - s.extend(one, two, -1)) - (at - s.extend(at, at + p, -1))
        for q in (right, left):
            ok = (q >= m) & (q < 2 * m)
            where.append(at[ok])
            period.append(q[ok])
    return np.concatenate(where), np.concatenate(period)


def find_runs(words: np.ndarray, doc: np.ndarray, left: np.ndarray, min_length: int = MIN_LENGTH,
              min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs by start, then period. ``words`` are hashes,
    ``doc`` the rising document number and ``left`` the words to its end, of every word."""
    none = np.zeros(0, np.int64)
    if min_periods < 3 or min_length < 2:
        raise ValueError("runs need three periods and two words at least")
    base = 1 << (((min_length + 1) // 3).bit_length() - 1)
    s = Suffixes(words, doc, left, base)
    if not len(s.at):
        return none, none, none
    i, q = _candidates(s)
    pair = np.unique(i * s.n + q)  # q < n
    i, q = pair // s.n, pair % s.n
    fits = q < left[i]
    i, q = i[fits], q[fits]
    start = i - s.extend(i, i + q, -1)
    end = i + q + s.extend(i, i + q, 1)
    ok = end - start >= np.maximum(min_length, min_periods * q)
    start, end, q = start[ok], end[ok], q[ok]
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(start) else start > 0
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return start[order], (end - start)[order], q[order]


def _find(min_length: int, min_periods: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            raw, off, _ = text_buffers(batch.column(1))
            h, doc = word_hashes(raw, off, fold=False)
            counts = np.bincount(doc, minlength=batch.num_rows)
            ends = np.cumsum(counts)
            start, length, period = find_runs(h, doc, ends[doc] - np.arange(len(doc)), min_length, min_periods)
            owner = doc[start]
            local = start - (ends - counts)[owner]
            cover = np.zeros(len(h) + 1, np.int64)
            np.add.at(cover, start + period, 1)
            np.add.at(cover, start + length, -1)
            keep = np.cumsum(cover)[:-1] == 0
            has = np.zeros(batch.num_rows, bool)
            has[owner] = True
            data, collapsed = raw.tobytes(), []
            for k, (a, b) in enumerate(itertools.pairwise(off.tolist())):
                words = data[a:b].split()
                if has[k]:
                    words = itertools.compress(words, keep[ends[k] - counts[k]:ends[k]].tolist())
                collapsed.append(b" ".join(words))
            runs = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(local), pa.array(length), pa.array(period)],
                                           ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
                schema=_FOUND)
    return fn


def find(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start, then period) and collapsed: the
    text without what a run repeats after its first period, words joined by one space."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _find(min_length, min_periods),
        "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
        "collapsed string")


def repeat_tail(text: Column, doc_id: Column) -> Column:
    """The text with a periodic tail in about every tenth document, as doc_id decides: with
    h = crc32(doc_id), g = h / 10, if h % 10 = 0, word i >= a = g % n becomes word
    a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8), all rounded down. Other texts, texts
    without words and rows without doc_id are unchanged."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def turned(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        # Arrays of one element bind a, p so that they are computed once.
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        return F.array_join(F.flatten(F.transform(F.array(F.struct(a.alias("a"), p.alias("p"))), lambda s: F.concat(
            F.slice(w, F.lit(1), s["a"].cast("int")),
            F.transform(F.slice(w, (s["a"] + 1).cast("int"), (n - s["a"]).cast("int")),
                        lambda _, i: F.get(w, (s["a"] + i % s["p"]).cast("int")))))), " ")

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"),
                  F.get(F.transform(F.array(words), turned), F.lit(0))).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest length / period, and the sha256 of all runs and of
    the collapsed text."""
    none = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("start", "length", "period")])
    # Runs come by start, then period, so the first of equals stays.
    best = F.aggregate("runs", none, lambda b, r: F.when(
        (b["period"] == 0) | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))), "")
    one = F.when(F.size("runs") > 0, F.col("_best"))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), one["start"].alias("start"),
        one["length"].alias("length"), one["period"].alias("period"),
        F.floor(one["length"] * 1000 / one["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
