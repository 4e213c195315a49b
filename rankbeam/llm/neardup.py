"""Embedding near-duplicates by NN-descent.

Vectors with one label are compared by cosine in double precision. Equal
vectors are one class. A neighbour graph of k edges per class starts from
blocks of a few random-hyperplane tables and is refined by neighbours-of-
neighbours joins: at each class its neighbours, forward and reverse, are
compared with each other and the better pairs replace edges. The number of
tables grows with the bits of a table, so that a pair at the threshold is likely
to share a block at any table size. The search runs at every size; a table whose labels
have at most ``BLOCK`` classes each is one block a label. A sample of classes is
compared with all rows; while the recall of its links is below the goal, further
tables and rounds follow. Only if that does not reach the goal are all classes
compared with all rows of their label, chunk by chunk, and the result is exact.

Recall is the mean, over sampled classes with a link, of the share of their linked
classes that was found; copies do not weigh. Classes with fewer than k links and
classes with more, which dense groups hold, must reach the goal each, so a dense
group cannot hide lost pairs. The sample grows until it holds ``SPARSE`` classes of
the first kind or ``SAMPLE`` classes; recall is judged by what it then holds.

Edges at or above the threshold are links and make components. A class whose
list is saturated (its k-th neighbour still links) may have more links than its
list holds, so its list is enlarged to its whole component: the component's
classes are compared in blocks of bounded size and each class counts its links
there, without a row per pair.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without a label, link with nothing and are their own
component; equal vectors link with each other; shorter vectors are padded with
zeros; repeated rows each count as a vector; a null id never names a component
unless its component has no other; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, discard, prepare, written
from .vectors import lists, matrix, usable

K = 8
BLOCK = 512
TABLES = 3
ROUNDS = 3
GOAL = 0.95
AUDIT = 256
EXTRA = 3
SPARSE = 64
SAMPLE = 16_384
CHUNK = 4096
_SPAN = 1 << 30  # values of the hash that orders the classes


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _best(sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k largest entries of each row; -inf never counts."""
    k = min(k, sim.shape[1])
    if k <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cols = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(sim)), k)
    cols = cols.reshape(-1)
    ok = np.isfinite(sim[rows, cols])
    return rows[ok], cols[ok]


def _edges(nodes: np.ndarray, u: np.ndarray, v: np.ndarray, cos: np.ndarray) -> pa.Table:
    return pa.table({"u": pa.array(nodes[u], pa.int64()), "v": pa.array(nodes[v], pa.int64()),
                     "cos": pa.array(cos, pa.float64())})


def _top(edges: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("u").orderBy(F.desc("cos"), "v")
    return (edges.groupBy("u", "v").agg(F.max("cos").alias("cos"))
            .withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r"))


def _bits(n: int) -> int:
    """Hyperplanes that cut n classes into blocks of half the bound."""
    return max(0, int(np.ceil(np.log2(max(1.0, n / (BLOCK / 2))))))


def _tables(bits: int, threshold: float) -> int:
    """Tables after which a pair at the threshold has shared a block with probability
    GOAL; from 64 on (low thresholds) the audit decides whether more are needed."""
    meet = (1 - np.arccos(np.clip(threshold, -1.0, 1.0)) / np.pi) ** bits
    miss = max(1 - meet, 1e-9)
    want = 64 if miss >= 1 else int(np.ceil(np.log(1 - GOAL) / np.log(miss)))
    return min(64, max(TABLES, want))


def _table(classes: DataFrame, sizes: dict, dim: int, seed: int, k: int) -> DataFrame:
    """Edges (u, v, cos) inside the blocks of one random-hyperplane table."""
    bits = {label: _bits(n) for label, n in sizes.items()}
    planes = np.random.default_rng(seed).standard_normal((dim, max([1, *bits.values()])))

    def place(batches):
        for b in batches:
            side = (matrix(b.column("vec"), dim) @ planes > 0).astype(np.int64)
            use = np.array([bits[x] for x in b.column("label").to_pylist()])
            side[np.arange(side.shape[1])[None, :] >= use[:, None]] = 0
            code = side @ (1 << np.arange(side.shape[1], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code)],
                                             names=[*b.schema.names, "code"])

    placed = classes.select("node", "label", "vec").mapInArrow(
        place, "node long, label long, vec array<double>, code long")
    crowd = placed.groupBy("label", "code").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    placed = placed.join(crowd, ["label", "code"]).withColumn(
        "part", F.pmod(F.xxhash64(F.lit(seed), "node"), F.col("parts")))

    def compare(t: pa.Table) -> pa.Table:
        nodes = t.column("node").to_numpy()
        x = matrix(t.column("vec"), dim)
        sim = x @ x.T
        np.fill_diagonal(sim, -np.inf)
        u, v = _best(sim, k)
        return _edges(nodes, u, v, sim[u, v])

    return placed.groupBy("label", "code", "part").applyInArrow(compare, "u long, v long, cos double")


def _descend(edges: DataFrame, classes: DataFrame, dim: int, k: int) -> DataFrame:
    """Better edges from neighbours of neighbours: every class compares its forward
    and reverse neighbours; crowded reverse lists are split, forward ones join each part."""
    worst = edges.groupBy("u").agg(F.min("cos").alias("kth"), F.count("*").alias("held")).select(
        F.col("u").alias("node"), F.when(F.col("held") >= k, F.col("kth")).otherwise(-2.0).alias("kth"))
    reverse = edges.select(F.col("v").alias("at"), F.col("u").alias("node"))
    parts = reverse.groupBy("at").agg(F.ceil(F.count("*") / (4 * k)).cast("int").alias("parts"))
    back = reverse.join(parts, "at").select(
        "at", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node")
    ahead = (edges.select(F.col("u").alias("at"), F.col("v").alias("node")).join(parts, "at", "left")
             .select("at", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
                     .alias("part"), "node"))
    met = back.union(ahead).distinct()
    known = classes.select("node", "vec").join(worst, "node", "left").select(
        "node", "vec", F.coalesce("kth", F.lit(-2.0)).alias("kth"))
    met = met.join(known, "node")
    spark = classes.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def compare(batches):
        def group(t: pa.Table):
            nodes = t.column("node").to_numpy()
            x = matrix(t.column("vec"), dim)
            kth = t.column("kth").to_numpy()
            key = np.stack([t.column("at").to_numpy(), t.column("part").to_numpy()], 1)
            cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            out = ([], [], [])
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(nodes)], strict=True):
                if hi - lo < 2:
                    continue
                sim = x[lo:hi] @ x[lo:hi].T
                np.fill_diagonal(sim, -np.inf)
                sim[sim <= kth[lo:hi, None]] = -np.inf
                u, v = _best(sim, k)
                out[0].append(u + lo)
                out[1].append(v + lo)
                out[2].append(sim[u, v])
            if out[0]:
                yield from _edges(nodes, *(np.concatenate(o) for o in out)).to_batches()

        held = None  # rows of a group may straddle batches
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            last = (t.column("at")[-1].as_py(), t.column("part")[-1].as_py())
            same = ((t.column("at").to_numpy() == last[0]) & (t.column("part").to_numpy() == last[1]))
            at = int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
            yield from group(t.slice(0, at)) if at else ()
            held = t.slice(at)
        if held is not None and held.num_rows:
            yield from group(held.combine_chunks())

    return (met.repartition(tasks, "at", "part").sortWithinPartitions("at", "part")
            .select("at", "part", "node", "vec", "kth")
            .mapInArrow(compare, "u long, v long, cos double"))


def _count_in_blocks(members: DataFrame, classes: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(node, links, partners) of every class of the given components: (component, node) rows.
    Blocks of a component meet in bounded tasks; only counts come out."""
    size = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb"))
    m = (members.join(size, "component").join(classes.select("node", "vec", "mult"), "node")
         .withColumn("i", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")))
    every = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
    one = m.withColumn("j", every).select("component", "i", "j", "node", "vec")
    two = (m.withColumnRenamed("i", "j2").withColumn("i2", every)
           .select(F.col("component").alias("c2"), "i2", "j2", F.col("node").alias("node2"),
                   F.col("vec").alias("vec2"), "mult"))

    def count(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("node", "links", "partners")})
        x, y = matrix(a.column("vec"), dim), matrix(b.column("vec2"), dim)
        na, nb = a.column("node").to_numpy(), b.column("node2").to_numpy()
        hit = (x @ y.T >= threshold) & (na[:, None] != nb[None, :])
        return pa.table({"node": pa.array(na), "links": pa.array(hit @ b.column("mult").to_numpy()),
                         "partners": pa.array(hit.sum(1), pa.int64())})

    return (one.groupBy("component", "i", "j").cogroup(two.groupBy("c2", "i2", "j2"))
            .applyInArrow(count, "node long, links long, partners long")
            .groupBy("node").agg(F.sum("links").alias("links"), F.sum("partners").alias("partners")))


def _forest(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a few true entries that connect all that the true entries do."""
    rows, cols = hit.any(1), hit.any(0)
    out: list[tuple[int, int]] = []
    while rows.any():
        front = [int(np.argmax(rows))]
        rows[front[0]] = False
        while front:
            r = front.pop()
            for c in np.flatnonzero(hit[r] & cols).tolist():
                cols[c] = False
                more = np.flatnonzero(hit[:, c] & rows).tolist()
                rows[more] = False
                out += [(r, c), *((m, c) for m in more)]
                front += more
    u, v = np.array(out, np.int64).reshape(-1, 2).T
    return u, v


def _audit(classes: DataFrame, lo: int, hi: int, dim: int, threshold: float) -> DataFrame:
    """The classes whose hash lies in [lo, hi) compared with every class: rows (node,
    null, links, partners), and rows (node, other, null, null) of pairs that connect
    what is linked. Links count rows, partners classes."""
    spark = classes.sparkSession
    place = F.pmod(F.xxhash64("node"), F.lit(_SPAN))
    sample = classes.where((place >= lo) & (place < hi)).select("node", "label", "vec").toArrow()
    shared = spark.sparkContext.broadcast((
        sample.column("node").to_numpy(), sample.column("label").to_numpy(),
        matrix(sample.column("vec"), dim)))
    names = ("node", "other", "links", "partners")

    def run(batches):
        nodes, labels, s = shared.value
        total, partners = np.zeros((2, len(nodes)), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                others = b.column("node").to_numpy(False)
                hit = s @ matrix(b.column("vec"), dim).T >= threshold
                hit &= labels[:, None] == b.column("label").to_numpy(False)[None, :]
                hit &= nodes[:, None] != others[None, :]
                total += hit @ b.column("mult").to_numpy(False)
                partners += hit.sum(1)
                u, v = _forest(hit)
                yield pa.RecordBatch.from_arrays([
                    pa.array(nodes[u], pa.int64()), pa.array(others[v], pa.int64()),
                    pa.nulls(len(u), pa.int64()), pa.nulls(len(u), pa.int64())], names=names)
        yield pa.RecordBatch.from_arrays([
            pa.array(nodes, pa.int64()), pa.nulls(len(nodes), pa.int64()),
            pa.array(total, pa.int64()), pa.array(partners, pa.int64())], names=names)

    return written(classes.select("node", "label", "vec", "mult").mapInArrow(
        run, "node long, other long, links long, partners long")
        .groupBy("node", "other").agg(F.sum("links").alias("links"), F.sum("partners").alias("partners")),
        "audit")


def _rows(parts: list[DataFrame]) -> DataFrame:
    """All rows of tables that ``written`` made."""
    one = parts[0]
    return one.sparkSession.read.schema(one.schema).parquet(*[p.written_path for p in parts])


def _exact(unit: DataFrame, done: list[DataFrame], at: int, n: int, dim: int, threshold: float):
    """((node, links), (node, component)) from comparing all classes with all classes;
    ``done`` are the audits of the classes whose hash is below ``at``."""
    cuts = np.linspace(at, _SPAN, max(1, -(-n * (_SPAN - at) // (_SPAN * CHUNK))) + 1).astype(np.int64).tolist()
    every = _rows(done + [_audit(unit, lo, hi, dim, threshold)
                          for lo, hi in zip(cuts[:-1], cuts[1:], strict=True) if lo < hi])
    pairs = every.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    return (every.where("other is null and links > 0").select("node", "links"),
            written(components(pairs, "vectors"), "vector_components"))


def _sampled(unit: DataFrame, n: int, dim: int, threshold: float, k: int) -> tuple[list[DataFrame], int]:
    """Audits of the classes whose hash is below a bound, and that bound: enough classes
    to hold SPARSE with a link and fewer than k linked classes, at most about SAMPLE."""
    parts, at, size, held = [], 0, AUDIT, 0
    end = min(_SPAN, -(-_SPAN * SAMPLE // n))
    while held < SPARSE and at < end:
        hi = min(end, at - (-_SPAN * size // n))
        parts.append(_audit(unit, at, hi, dim, threshold))
        held += parts[-1].where(F.col("other").isNull() & F.col("partners").between(1, k - 1)).count()
        at, size = hi, min(4 * size, CHUNK)
    return parts, at


def _recalls(truth: DataFrame, links: DataFrame, k: int) -> dict[bool, float]:
    """Mean share of a sampled class's linked classes that ``links`` has, over classes
    with a link: of those with fewer than k (False) and of the others (True)."""
    share = F.least(F.lit(1.0), F.coalesce("partners", F.lit(0)) / F.col("truth"))
    got = (truth.where("truth > 0").join(links.select("node", "partners"), "node", "left")
           .groupBy((F.col("truth") >= k).alias("dense")).agg(F.avg(share).alias("recall")).collect())
    return {r["dense"]: r["recall"] for r in got}


def link(vectors: DataFrame, threshold: float = 0.93, k: int = K, id_col: str = "vec_id",
         vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"),
                          F.col(label_col).cast("long").alias("label"))
    some = F.exists("v", lambda x: x != 0)
    fit = usable(F.col("v")) & some & F.col("label").isNotNull()
    classes = written(rows.where(fit).groupBy("label", "v").agg(
        F.count("*").alias("mult"), F.min("vec_id").alias("rep"))
        .withColumn("node", F.monotonically_increasing_id()), "vector_classes")
    dim = classes.agg(F.max(F.size("v"))).first()[0]
    own = F.col("vec_id")
    if dim is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                           own.alias("component_id"), F.lit(True).alias("kept"))

    def normal(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("label"), b.column("mult"),
                 lists(_unit(matrix(b.column("v"), dim)))], names=["node", "label", "mult", "vec"])

    unit = written(classes.select("node", "label", "mult", "v").mapInArrow(
        normal, "node long, label long, mult long, vec array<double>"), "unit")
    # the number of classes per label; labels are categories, a few numbers on the driver
    sizes = {r["label"]: r["n"] for r in unit.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(sizes.values())
    audits, at = _sampled(unit, n, dim, threshold, k)
    truth = _rows(audits).where("other is null").select("node", F.col("partners").alias("truth"))

    bits = _bits(max(sizes.values()))
    tables, rounds = _tables(bits, threshold), max(ROUNDS, -(-bits // 3))
    edges = None
    seed = 0
    for attempt in range(1 + max(EXTRA, bits)):
        todo = tables if attempt == 0 else 1
        while todo:
            before, made = edges, []
            for _ in range(min(todo, TABLES)):
                seed += 1
                todo -= 1
                made.append(_table(unit, sizes, dim, seed, k))
            edges = written(_top(reduce(DataFrame.union, ([before] if before else []) + made), k), "graph")
            discard(*([before] if before else []))
        for _ in range(rounds if attempt == 0 else 1):
            better = written(_descend(edges, unit, dim, k), "better")
            if better.isEmpty():
                discard(better)
                break
            before, edges = edges, written(_top(edges.union(better), k), "graph")
            discard(before, better)
        found = _links(edges, unit, dim, threshold, k)
        if all(r >= GOAL for r in _recalls(truth, found[0], k).values()):
            break
    else:
        found = _exact(unit, audits, at, n, dim, threshold)
    links, comp = found
    named = (classes.select("label", "v", "node", "rep", "mult").join(comp, "node", "left")
             .join(links, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    low = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(low, "component").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n"), "component_id")
    got = rows.where(fit).join(named, ["label", "v"]).select(
        "vec_id", F.col("n").alias("n_links"), "component_id")
    rest = rows.where(~F.coalesce(fit, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), own.alias("component_id"))
    return got.union(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(edges: DataFrame, unit: DataFrame, dim: int, threshold: float, k: int):
    """((node, links, partners), (node, component)) from the graph's edges."""
    near = edges.where(F.col("cos") >= threshold).select(F.col("u").alias("a"), F.col("v").alias("b"))
    near = written(near.union(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                   "near")
    comp = written(components(near, "vectors"), "vector_components")
    full = (edges.where(F.col("cos") >= threshold).groupBy("u").agg(F.count("*").alias("c"))
            .where(F.col("c") >= k).select(F.col("u").alias("node")))
    crowded = full.join(comp, "node").select("component").distinct()
    members = written(comp.join(crowded, "component"), "crowded")
    dense = _count_in_blocks(members, unit, dim, threshold)
    sparse = (near.join(members.select(F.col("node").alias("a")), "a", "left_anti")
              .join(unit.select(F.col("node").alias("b"), "mult"), "b")
              .groupBy("a").agg(F.sum("mult").alias("links"), F.count("*").alias("partners"))
              .withColumnRenamed("a", "node"))
    return written(dense.union(sparse), "link_counts"), comp
