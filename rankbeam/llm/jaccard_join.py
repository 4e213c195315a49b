"""N-gram Jaccard join by multiple-global-order filtering.

Two documents link when their sets of word shingles have a Jaccard similarity
of ``percent``/100 or more. Sets that similar must share a token among the
first ``n - ceil(J n) + 1`` tokens of each set, whatever total order the tokens
are put in. So candidates are pairs that meet in a prefix under the first
order and in their prefixes under every further order: one pass over the texts
writes each class's prefixes under all orders, the pairs that the first order
proposes are joined to the prefixes of the others, and only pairs that meet in
all of them have their texts joined and their whole sets compared. Blocks of
clusters are filtered by the same further orders before their sets are counted.

The first order puts rare tokens first: a table of token counts (hashed buckets
that hold the level of their most frequent token, counted over all documents)
ranks the tokens, so that passages which many documents share leave the prefixes. Any order gives whole results;
the counts only keep the candidates few.

Large groups of copies never meet pair by pair. Equal sets are one class. Each
class is compared with a few leaders of every group that has the same smallest
token under one of a few hash orders (stars; the leaders are the members that
share most smallest tokens with the others, so they stand in the middle of
their group). The candidate search that follows only looks for links between
the components that the stars made, which is all that components need: tokens
in few prefixes pair their classes by a join; classes that meet in a token of
many prefixes form a cluster, whose classes outside its largest component are
compared, in blocks of bounded size, with all of it.

Defined results: null text and text without words have an empty set, link with
nothing and are their own component; repeated rows come back as often as they
came in, in one class; a class whose ids are all null links through nothing
and has a null component; an empty table gives no rows. Extra columns are
ignored by ``components_of`` and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, discard, prepare, shield, slices, written
from .shingles import mix, shingle_sets

_U = np.uint64
#: Hash orders whose smallest token is kept; the first ones also group the stars.
SMALLEST = 32
STAR_ORDERS = 6
LEADERS = 4
#: Further orders in which the prefixes of a candidate pair must meet.
FILTER_ORDERS = 2
#: A token in more prefixes than this makes a cluster, compared in blocks of classes.
CLUSTER_FROM = 48
CLUSTER_BLOCK = 256
#: A block of verification holds about so many texts, or so many shingles.
BLOCK_ROWS = 128
BLOCK_SHINGLES = 400_000
#: Tokens are counted in parts of about so many, by 24 bits of their hash within a part;
#: a task packs its tokens when it holds so many.
PART_TOKENS = 1 << 20
CELL_BITS = 24
HELD_TOKENS = 4 << 20
#: Bytes of text hashed at once; hashing holds some fifty times that.
SLICE = 1 << 20


def _prefix_size(n, percent: int):
    return n - F.floor((n * percent + 99) / 100) + 1


def _seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95))


def _prefix_len(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _describe(docs: DataFrame, width: int) -> DataFrame:
    """One narrow row per document: set size, set fingerprint, smallest tokens."""
    def run(batches):
        factors = _seeds(SMALLEST) | _U(1)
        for b in slices(batches, "text", SLICE):
            sets = shingle_sets(b.column("text"), width)
            small = [[int((s * f).min()) >> 24 for f in factors] if len(s) else None for s in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "text_hash": b.column("text_hash"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "fp": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                                if len(s) else None for s in sets], pa.binary()),
                "small": pa.array(small, pa.list_(pa.int64()))})

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, n long, fp binary, small array<long>")


def _pack(cells: np.ndarray) -> bytes:
    """Sorted numbers below 2**24 as compressed byte planes of their differences."""
    steps = np.diff(cells, prepend=cells.dtype.type(0)).astype("<u4")
    return pa.compress(steps.view(np.uint8).reshape(-1, 4)[:, :3].T.tobytes(), "zstd", asbytes=True)


def _unpack(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 3 * n, "zstd", asbytes=True), np.uint8).reshape(3, n)
    steps = np.zeros((n, 4), np.uint8)
    steps[:, :3] = planes.T
    return np.cumsum(steps.view("<u4")[:, 0], dtype=np.uint32)


def _token_levels(texts: DataFrame, width: int, total: int):
    """log2 of the token counts over all classes, as one byte per bucket of tokens.

    Tokens are counted by ``part_bits`` + 24 bits of their hash, some sixteen such cells
    for each token of the table at every size, so counts of different tokens hardly
    mix; a bucket has the level of its most frequent cell. The number of buckets
    follows the number of tokens (an eighth of it), from 2**16 to 2**25; at most 32 MB
    come to the driver and go out again. Tokens travel to their part as packed cells,
    about two bytes each.
    """
    bits = min(25, max(16, (max(1, total) // 8).bit_length()))
    part_bits = min(bits, (max(0, total) // PART_TOKENS).bit_length())
    key_bits, own_bits = part_bits + CELL_BITS, bits - part_bits

    def count(batches):
        held, size = [], 0

        def packed():
            keys = np.concatenate(held)
            keys.sort()
            at = np.searchsorted(keys, np.arange((1 << part_bits) + 1, dtype=np.uint64) << _U(CELL_BITS))
            cells = (keys & _U((1 << CELL_BITS) - 1)).astype(np.uint32)
            used = np.flatnonzero(np.diff(at))
            for lo in range(0, len(used), 256):
                some = used[lo:lo + 256]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(some, pa.int32()), "n": pa.array(np.diff(at)[some], pa.int32()),
                    "cells": pa.array([_pack(cells[at[i]:at[i + 1]]) for i in some], pa.binary())})

        for b in slices(batches, "text", SLICE):
            sets = shingle_sets(b.column("text"), width)
            held += [s >> _U(64 - key_bits) for s in sets if len(s)]
            size += sum(map(len, sets))
            if size >= HELD_TOKENS:
                yield from packed()
                held, size = [], 0
        if held:
            yield from packed()

    def add(key, group):
        cells = np.concatenate([_unpack(raw, n) for raw, n in zip(
            group.column("cells").to_pylist(), group.column("n").to_pylist(), strict=True)])
        cells, counts = np.unique(cells, return_counts=True)
        cells, counts = cells[counts > 1], counts[counts > 1]
        level = np.zeros(1 << own_bits, np.uint8)
        np.maximum.at(level, cells >> np.uint32(CELL_BITS - own_bits), np.log2(counts).astype(np.uint8))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                         "level": pa.array([level.tobytes()], pa.binary())})

    rows = written(texts.select("text").mapInArrow(count, "part int, n int, cells binary")
                   .groupBy("part").applyInArrow(add, "part int, level binary"), "levels")
    levels = np.zeros((1 << part_bits, 1 << own_bits), np.uint8)
    for r in rows.toLocalIterator():
        levels[r["part"]] = np.frombuffer(r["level"], np.uint8)
    discard(rows)
    levels = levels.reshape(-1)
    # rare tokens share the buckets of frequent ones: these are an eighth of the buckets at most
    above = np.cumsum(np.bincount(levels, minlength=65)[::-1])[::-1]
    levels[levels < max(1, int(np.argmax(above <= len(levels) / 8)))] = 0
    return bits, levels


def _rare_first(tokens: np.ndarray, k: int, bits: int, levels: np.ndarray) -> np.ndarray:
    """The first ``k`` tokens when ordered by (count level, hash); ``tokens`` is sorted."""
    level = levels[(tokens >> _U(64 - bits)).astype(np.int64)]
    return tokens[np.argsort(level, kind="stable")[:k]]


def _further(tokens: np.ndarray, k: int, seed: np.uint64) -> np.ndarray:
    """The first ``k`` tokens under one hash order, as the upper 32 bits of their place in it."""
    return (np.partition(mix(tokens ^ seed), k - 1)[:k] >> _U(32)).astype(np.uint32).view(np.int32)


def _order_seeds() -> np.ndarray:
    return _seeds(SMALLEST + FILTER_ORDERS)[SMALLEST:]


def _prefixes(texts: DataFrame, width: int, percent: int, bits: int, shared) -> DataFrame:
    """(node, comp, n, tokens, o0, o1, ...): the prefixes of every class under all orders."""
    def run(batches):
        levels = shared.value
        for b in slices(batches, "text", SLICE):
            sets = shingle_sets(b.column("text"), width)
            ks = [_prefix_len(len(s), percent) if len(s) else 0 for s in sets]
            off = pa.array(np.concatenate([[0], np.cumsum(ks)]).astype(np.int32))

            def cut(kind, first, sets=sets, ks=ks, off=off):
                picks = [first(s, k) for s, k in zip(sets, ks, strict=True) if k]
                flat = np.concatenate(picks) if picks else np.zeros(0, kind)
                return pa.ListArray.from_arrays(off, pa.array(flat.view(kind)))

            yield pa.RecordBatch.from_pydict({
                "node": b.column("node"), "comp": b.column("comp"),
                "n": pa.array([len(s) for s in sets], pa.int32()),
                "tokens": cut(np.int64, lambda s, k: _rare_first(s, k, bits, levels)),
                **{f"o{i}": cut(np.int32, lambda s, k, seed=seed: _further(s, k, seed))
                   for i, seed in enumerate(_order_seeds())}})

    orders = "".join(f", o{i} array<int>" for i in range(FILTER_ORDERS))
    return texts.select("node", "comp", "text").mapInArrow(
        run, f"node long, comp long, n int, tokens array<long>{orders}")


def _intersect(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose prefixes meet under every further order; reads no text."""
    names = [f"o{i}" for i in range(FILTER_ORDERS)]
    for end in ("a", "b"):
        pairs = pairs.join(prefixes.select(F.col("node").alias(end), *[
            F.col(o).alias(f"{end}_{o}") for o in names]), end)
    for o in names:
        pairs = pairs.where(F.arrays_overlap(f"a_{o}", f"b_{o}"))
    return pairs.drop(*[f"{end}_{o}" for end in ("a", "b") for o in names])


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted distinct hash arrays."""
    if not len(a) or not len(b):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _meets(a: np.ndarray, b: np.ndarray, percent: int, seeds: np.ndarray) -> bool:
    """Do the prefixes meet under each of the further hash orders?"""
    ka, kb = _prefix_len(len(a), percent), _prefix_len(len(b), percent)
    for seed in seeds:
        pa_ = np.partition(mix(a ^ seed), ka - 1)[:ka]
        pb_ = np.partition(mix(b ^ seed), kb - 1)[:kb]
        if not np.isin(pa_, pb_).any():
            return False
    return True


def _verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int,
            filtered: bool = False) -> DataFrame:
    """The pairs (a, b) that link. Texts of ``b`` are streamed past their ``a``;
    unless they are ``filtered`` already, the further orders are tested first.

    A node with many pairs is split into blocks, each with its own copy of the
    node's text, so no task gathers more than one block.
    """
    pairs = written(pairs, "pairs")
    load = pairs.groupBy("a").agg(F.greatest(
        F.ceil(F.count("*") / F.lit(BLOCK_ROWS)), F.ceil(F.sum("nb") / F.lit(BLOCK_SHINGLES)))
        .alias("parts"))
    blocked = pairs.join(load, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    blocked = written(blocked, "blocks")
    right = (blocked.join(texts.select(F.col("node").alias("b"), "text"), "b")
             .select("a", "part", "b", "text"))
    left = (blocked.select("a", "part").distinct()
            .join(texts.select(F.col("node").alias("a"), "text"), "a").select("a", "part", "text").toDF("la", "lpart", "own"))
    seeds = _order_seeds()[:0] if filtered else _order_seeds()

    def check(key, one, many):
        own = shingle_sets(one.column("own").slice(0, 1), width)[0] if one.num_rows else None
        hits = set()
        for batch in slices(iter(many.to_batches()), "text", SLICE):
            ids = batch.column("b").to_pylist()
            for node, s in zip(ids, shingle_sets(batch.column("text"), width), strict=True):
                if own is not None and len(own) and len(s) and _meets(own, s, percent, seeds) \
                        and similar(own, s, percent):
                    hits.add(node)
        return pa.table({"a": pa.array([key[0].as_py()] * len(hits), pa.int64()),
                         "b": pa.array(sorted(hits), pa.int64())})

    return (left.groupBy("la", "lpart").cogroup(right.groupBy("a", "part"))
            .applyInArrow(check, "a long, b long"))


def _star_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b, nb): every class with the leaders of its smallest-token groups."""
    keys = classes.select("node", "n", F.posexplode("small").alias("k", "token"))
    common = keys.groupBy("k", "token").agg(F.count("*").alias("size")).where("size > 1")
    scored = (keys.join(common, ["k", "token"]).groupBy("node")
              .agg(F.sum(F.log2("size")).alias("score")))
    keys = written(keys.where(F.col("k") < STAR_ORDERS).join(scored, "node"), "star_keys")
    rank = [F.max(F.struct((F.col("score") - F.pmod(F.xxhash64(F.lit(j), "node"), F.lit(1 + 6 * j)))
                           .alias("s"), "node", "n")).alias(f"l{j}") for j in range(LEADERS)]
    leaders = (keys.groupBy("k", "token").agg(F.count("*").alias("size"), *rank).where("size > 1")
               .select("k", "token", F.explode(F.array_distinct(F.array(*[
                   F.struct(F.col(f"l{j}.node").alias("node"), F.col(f"l{j}.n").alias("n"))
                   for j in range(LEADERS)]))).alias("l"))
               .select("k", "token", F.col("l.node").alias("a"), F.col("l.n").alias("an")))
    pairs = (keys.join(leaders, ["k", "token"]).where("node <> a")
             .where(_sizes_fit("an", "n", percent))
             .select("a", F.col("node").alias("b"), F.col("n").alias("nb")).distinct())
    # a leader that shares few smallest tokens is hardly similar; the candidate
    # search decides about such pairs, the stars only save it work
    sketch = classes.select("node", "small")
    both = (pairs.join(sketch.toDF("a", "sa"), "a").join(sketch.toDF("b", "sb"), "b")
            .withColumn("same", F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y),
                                                lambda x: x))))
    return both.where(F.col("same") >= int(SMALLEST * (percent / 100) ** 2)).select("a", "b", "nb")


def _clusters(index: DataFrame) -> DataFrame:
    """(cluster, node, comp) of the classes that meet in tokens of many prefixes."""
    hub = index.groupBy("token").agg(F.min("node").alias("hub"))
    met = index.join(hub, "token").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    named = components(met.where("a <> b").distinct(), "clusters")
    return written(index.select("node", "comp").distinct().join(named, "node")
                   .select(F.col("component").alias("cluster"), "node", "comp"), "clusters")


def _blocks(clusters: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) that join different components of a cluster.

    The classes outside the cluster's largest component, in blocks, meet all
    its classes, in blocks; each pair of blocks is one bounded task that counts
    shared shingles exactly and returns only links that join components.
    """
    sizes = clusters.groupBy("cluster", "comp").agg(F.count("*").alias("c"))
    shape = (sizes.groupBy("cluster").agg(F.max(F.struct("c", "comp")).alias("top"),
                                          F.sum("c").alias("all"))
             .select("cluster", F.col("top.comp").alias("main"),
                     F.ceil(F.col("all") / CLUSTER_BLOCK).cast("int").alias("na"),
                     F.ceil((F.col("all") - F.col("top.c")) / CLUSTER_BLOCK).cast("int").alias("nl"))
             .where("nl > 0"))
    c = written(clusters.join(shape, "cluster"), "shapes")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    body = texts.select("node", "text")
    rest = (c.where("comp <> main").join(body, "node")
            .select("cluster", block("nl").alias("i"), upto("na").alias("j"), "node", "comp", "text"))
    full = (c.join(body, "node")
            .select("cluster", upto("nl").alias("i"), block("na").alias("j"), "node", "comp", "text")
            .toDF("cluster2", "i2", "j2", "node", "comp", "text"))

    def check(one, two):
        links = _join_components(one, two, width, percent) if one.num_rows and two.num_rows else []
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                         "b": pa.array([y for _, y in links], pa.int64())})

    return (rest.groupBy("cluster", "i", "j").cogroup(full.groupBy("cluster2", "i2", "j2"))
            .applyInArrow(check, "a long, b long"))


def _common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``one`` shares with each of ``two``."""
    out = np.zeros((len(one), len(two)), np.float32)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (one, two)]
    both = [np.concatenate(x) for x in (one, two)]
    shared, back = np.unique(np.concatenate(both), return_inverse=True)
    cols = [back[:len(both[0])], back[len(both[0]):]]
    used = np.zeros((2, len(shared)), bool)
    used[0, cols[0]] = used[1, cols[1]] = True
    meets = used.all(0)  # only elements of both sides count
    code = np.cumsum(meets) - 1
    kept = []
    for r, c in zip(rows, cols, strict=True):
        r, c = r[meets[c]], code[c[meets[c]]]
        order = np.argsort(c, kind="stable")
        kept.append((r[order], c[order]))
    step = 4096
    for lo in range(0, int(meets.sum()), step):
        m = []
        for (r, c), x in zip(kept, (one, two), strict=True):
            a, b = np.searchsorted(c, [lo, lo + step])
            dense = np.zeros((len(x), step), np.float32)
            dense[r[a:b], c[a:b] - lo] = 1
            m.append(dense)
        out += m[0] @ m[1].T
    return np.rint(out).astype(np.int64)


def _join_components(one: pa.Table, two: pa.Table, width: int, percent: int) -> list:
    """Links between two blocks that join components not joined by earlier ones."""
    sets = [[s for b in slices(iter(t.to_batches()), "text", SLICE) for s in
             shingle_sets(b.column("text"), width)] for t in (one, two)]
    nodes = [t.column("node").to_pylist() for t in (one, two)]
    comps = [t.column("comp").to_pylist() for t in (one, two)]
    sizes = [np.array([len(s) for s in x], np.int64) for x in sets]
    small, large = (f(sizes[0][:, None], sizes[1][None, :]) for f in (np.minimum, np.maximum))
    maybe = (small * 100 >= large * percent) & (small > 0)
    for seed in _order_seeds():  # every further order takes pairs away
        short = [[_further(s, _prefix_len(len(s), percent), seed) if len(s) else s.astype(np.int32)
                  for s in x] for x in sets]
        maybe &= _common(*short) > 0
    i, j = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
    if not len(i):
        return []
    common = np.zeros(maybe.shape, np.int64)
    common[np.ix_(i, j)] = _common([sets[0][x] for x in i], [sets[1][x] for x in j])
    union = sizes[0][:, None] + sizes[1][None, :] - common
    hits = maybe & (100 * common >= percent * union)
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(hits)), strict=True):
        p, q = root(comps[0][i]), root(comps[1][j])
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((nodes[0][i], nodes[1][j]))
    return out


def components_of(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(_describe(docs, width), "sets")
    full = rows.where("n > 0")
    classes = written(
        full.groupBy("fp").agg(F.min(F.when(F.col("doc_id").isNotNull(),
                                            F.struct("doc_id", "text_hash"))).alias("r"),
                               F.min("doc_id").alias("rep"),
                               F.first("n").alias("n"), F.first("small").alias("small"))
        .select("fp", F.monotonically_increasing_id().alias("node"), "rep", "n", "small",
                F.col("r.text_hash").alias("text_hash"),
                F.col("r.doc_id").alias("row_id")), "classes")
    owner = classes.select("node", "row_id", "text_hash")
    texts = (docs.withColumn("text_hash", F.xxhash64("text"))
             .join(owner.withColumnRenamed("row_id", "doc_id"), ["doc_id", "text_hash"])
             .select("node", "text"))
    texts = written(texts, "texts")

    # stars: every class against the leaders of its smallest-token groups
    links = written(_verify(_star_pairs(classes, percent), texts, width, percent), "star_links")
    comp = written(components(links, "stars"), "star_components")

    labelled = (texts.join(comp.withColumnRenamed("component", "comp"), "node", "left")
                .select("node", F.coalesce("comp", "node").alias("comp"), "text"))
    total = classes.agg(F.sum("n")).first()[0] or 0
    bits, levels = _token_levels(texts, width, total)
    shared = spark.sparkContext.broadcast(levels)
    prefixes = written(_prefixes(labelled, width, percent, bits, shared), "prefixes")
    index = prefixes.select(F.explode("tokens").alias("token"), "node", "comp", "n")
    w = Window.partitionBy("token")
    index = (index.withColumns({"lo": F.min("comp").over(w), "hi": F.max("comp").over(w),
                                "met": F.count("*").over(w)})
             .where("lo < hi").drop("lo", "hi"))
    index = written(index, "index")
    few = index.where(F.col("met") <= CLUSTER_FROM)
    x = few.select("token", F.col("node").alias("a"), F.col("comp").alias("ca"),
                   F.col("n").alias("na"))
    y = few.select("token", F.col("node").alias("b"), F.col("comp").alias("cb"),
                   F.col("n").alias("nb"))
    # With one order, what the shorter-reaching prefix holds of the other set lies in
    # the other prefix: the overlap is at most the shared prefix tokens plus the rest.
    rest = F.greatest(*[F.col(n) - _prefix_size(F.col(n), percent) for n in ("na", "nb")])
    pairs = (x.join(y, "token").where("a < b and ca <> cb").where(_sizes_fit("na", "nb", percent))
             .groupBy("a", "b", "na", "nb").agg(F.count("*").alias("shared"))
             .where((F.col("shared") + rest) * (100 + percent) >= (F.col("na") + F.col("nb")) * percent)
             .select("a", "b", "nb"))
    pairs = _intersect(pairs, prefixes)
    more = written(_verify(pairs, texts, width, percent, filtered=True), "links")
    discard(prefixes)
    clusters = _clusters(index.where(F.col("met") > CLUSTER_FROM))
    more = more.union(written(_blocks(clusters, texts, width, percent), "block_links"))
    final = components(links.union(more), "all")
    # what is returned reads the sets, the classes and the last component table
    discard(texts, index, links, comp)
    named = classes.select("fp", "node", "rep").join(final, "node", "left")
    named = named.select("fp", "rep", F.coalesce("component", "node").alias("component"))
    low = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(low, "component").select("fp", "component_id")
    return (rows.join(named, "fp", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id")))


def _sizes_fit(n: str, m: str, percent: int):
    """J >= percent/100 needs min(n, m) * 100 >= max(n, m) * percent."""
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent)


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the row of the smallest id.

    Rows whose id is null are kept (they cannot be named); of several rows with
    the component's id the one with the smallest text hash stays, once.
    """
    docs, restore = shield(docs, ())
    comps = components_of(docs, width, percent)
    keep = comps.where("doc_id = component_id").select("doc_id").distinct()
    ids = F.col("doc_id")
    h = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    marked = docs.withColumn("__h", h)
    firsts = (marked.where(ids.isNotNull()).groupBy("doc_id").agg(F.min("__h").alias("__m"),
                                                                  F.count("*").alias("__c"))
              .where("__c > 1"))
    once = marked.join(keep, "doc_id", "left_semi")
    single = once.join(firsts, "doc_id", "left_anti")
    repeated = (once.join(firsts, "doc_id").where("__h = __m")
                .drop("__m", "__c").dropDuplicates(["doc_id"]))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return restore(single.select(*cols).union(repeated.select(*cols))
                   .union(marked.where(ids.isNull()).select(*cols)))
