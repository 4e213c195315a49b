"""Exact top-k inner product search in an M-tree of paged metric nodes.

Vectors are turned into integers, floor(256 x). One added component,
sqrt(M - |x|^2) with M the largest squared norm, makes all rows equally long,
so the highest inner product with a query (added component 0) is the smallest
Euclidean distance, a metric: d^2 = |q|^2 + M - 2 q.x.

The tree has three levels. Routing objects (a bounded sample of rows) split the
rows into shards by the nearest object; a shard of too many rows (copies of one
vector, say) is split further by a hash. Inside a shard, leaf pages of at most
``PAGE`` entries hold a centre, a covering radius, the centre's distance to its
routing object and each entry's distance to the centre. The pages are a table
in the shared folder.

A query first searches the shard whose ball is nearest. The distance of its
k-th result bounds everything after: shards and pages whose ball lies further
away are not visited, a page whose stored parent distance rules it out is not
even measured, and entries whose stored distance to the centre rules them out
are not computed. Pages are visited nearest bound first. Results are exact:
a ball is left out only when no row in it can reach the k-th result.

Defined results: vectors that are null, empty or hold null or non-finite
components and rows without an id take no part, as query or candidate, nor do vectors
with a component of 1e150 or more in size, whose squares a double does not hold;
scores are exact integers, beyond the range of a long its nearest end; shorter
vectors are padded with zeros; a query never meets rows with its own id; of several query rows with one
id the smallest vector (array order) asks; repeated candidate rows each count;
ties go to the smaller id; fewer than k candidates give them all; an empty
table, or one without queries, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, written
from .vectors import lists, matrix, usable

SCALE = 256.0
PAGE = 128
SHARD_ROWS = 4096
MAX_ROUTES = 512
QUERY_BLOCK = 2048


def _integers(col: pa.Array, dim: int) -> np.ndarray:
    return np.floor(matrix(col, dim) * SCALE)


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(0.0, top - (x * x).sum(1)))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(d2, 0))


def _products(rows: np.ndarray, q: np.ndarray, top: float) -> np.ndarray:
    """Exact inner products of integer rows with ``q``; no squared norm is above ``top``."""
    if top < 2.0 ** 52:  # every partial sum is a whole double
        return (rows @ q).astype(np.int64)
    if top < 2.0 ** 62:
        return rows.astype(np.int64) @ q.astype(np.int64)
    whole = [int(v) for v in q.tolist()]
    sums = [sum(int(v) * w for v, w in zip(r, whole, strict=True)) for r in rows.tolist()]
    return np.array([min(max(v, -2 ** 63), 2 ** 63 - 1) for v in sums], np.int64)


def _square(vec: str) -> Column:
    """Squared norm of a vector's integers; doubles from 2**53 on are whole already."""
    def add(a, x):
        v = x.cast("double") * SCALE
        v = F.when(F.abs(v) < 2.0 ** 53, F.floor(v).cast("double")).otherwise(v)
        return a + v * v

    return F.aggregate(vec, F.lit(0.0), add)


def _slack(top: float) -> float:
    """Rounding of a distance between rows of squared norm ``top``; bounds are
    loosened by it."""
    return 1e-6 * (1 + float(np.sqrt(top)))


def build_pages(ids: np.ndarray, x: np.ndarray, route: np.ndarray) -> list[dict]:
    """Leaf pages of one shard (x: lifted rows): centres by farthest-first choice,
    rows to the nearest centre, crowded pages cut by distance."""
    n = len(ids)
    want = max(1, -(-n // (PAGE * 3 // 4)))
    picks = [int(np.argmax(_distances(x, route[None])[:, 0]))]
    near = _distances(x, x[picks])[:, 0]
    while len(picks) < want and near.max() > 0:
        picks.append(int(np.argmax(near)))
        near = np.minimum(near, _distances(x, x[picks[-1:]])[:, 0])
    owner = _distances(x, x[picks]).argmin(1)
    pages = []
    for p in range(len(picks)):
        rows = np.flatnonzero(owner == p)
        d = _distances(x[rows], x[picks[p]][None])[:, 0] if len(rows) else rows
        rows = rows[np.argsort(d, kind="stable")]
        for lo in range(0, len(rows), PAGE):
            part = rows[lo:lo + PAGE]
            centre = x[picks[p]] if lo == 0 else x[part].mean(0)
            dist = _distances(x[part], centre[None])[:, 0]
            pages.append({"centre": centre, "radius": float(dist.max()),
                          "up": float(_distances(centre[None], route[None])[0, 0]),
                          "ids": ids[part], "rows": x[part], "dist": dist})
    return pages


def search_shard(pages: list[dict], route: np.ndarray, qids: np.ndarray, q: np.ndarray,
                 bound: np.ndarray, top: float, k: int):
    """Results (query row, id, score) in one shard at distance <= ``bound`` of each
    query, at most k each, by best-first search."""
    if not pages:
        return []
    centres = np.stack([p["centre"] for p in pages])
    radius = np.array([p["radius"] for p in pages])
    up = np.array([p["up"] for p in pages])
    lifted = np.hstack([q, np.zeros((len(q), 1))])
    to_route = _distances(lifted, route[None])[:, 0]
    norms = (q * q).sum(1)
    slack = _slack(top)
    out = []
    for i in range(len(q)):
        tau = bound[i]
        # the stored parent distance bounds the ball before its centre is measured
        open_ = np.flatnonzero(np.abs(to_route[i] - up) - radius <= tau + slack)
        if not len(open_):
            continue
        d = _distances(lifted[i:i + 1], centres[open_])[0]
        low = np.maximum(0, d - radius[open_])
        best: list[tuple[int, int]] = []  # (-score, id)
        for at in np.argsort(low, kind="stable"):
            if low[at] > tau + slack:
                break
            page = pages[open_[at]]
            keep = np.flatnonzero((np.abs(d[at] - page["dist"]) <= tau + slack)
                                  & (page["ids"] != qids[i]))
            if not len(keep):
                continue
            scores = _products(page["rows"][keep, :-1], q[i], top)
            if len(best) == k:  # only scores that reach the k-th so far
                keep, scores = (x[scores >= -best[-1][0]] for x in (keep, scores))
            best += [(-v, at_id) for v, at_id in zip(scores.tolist(), page["ids"][keep].tolist(), strict=True)]
            best = sorted(best)[:k]
            if len(best) == k:
                tau = min(tau, float(np.sqrt(max(0.0, norms[i] + top + 2.0 * best[-1][0]))))
        out += [(i, v, -s) for s, v in best]
    return out


def _pages_from(t: pa.Table, width: int) -> tuple[list[dict], np.ndarray]:
    pages = []
    route = np.zeros(width)
    for r in t.to_pylist():
        route = np.frombuffer(r["route"])
        ids = np.frombuffer(r["ids"], np.int64)
        pages.append({"centre": np.frombuffer(r["centre"]), "radius": r["radius"], "up": r["up"],
                      "ids": ids, "rows": np.frombuffer(r["rows"]).reshape(len(ids), width),
                      "dist": np.frombuffer(r["dist"])})
    return pages, route


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every
    query row against all rows with another id."""
    spark = prepare(vectors.sparkSession)
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = (vectors.where(usable(F.col(vec_col)))
            .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"),
                    is_query.alias("asks")).where("id is not null"))
    rows = rows.where(~F.exists("v", lambda x: F.abs(x.cast("double")) >= 1e150))
    total, dim, top = rows.agg(F.count("*"), F.max(F.size("v")), F.max(_square("v"))).first()
    if not total:
        return none
    routes = min(MAX_ROUTES, max(1, -(-total // SHARD_ROWS)))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(routes).select("v").toArrow()
    centres = _lift(_integers(sample.column("v"), dim), top)
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches):
        c = shared.value
        for b in batches:
            x = _lift(_integers(b.column("v"), dim), top)
            d = _distances(x, c)
            near = d.argmin(1)
            yield pa.RecordBatch.from_pydict({
                "id": b.column("id"), "x": lists(x), "shard": pa.array(near.astype(np.int32)),
                "d": pa.array(d[np.arange(len(near)), near])})

    placed = written(rows.select("id", "v").mapInArrow(
        assign, "id long, x array<double>, shard int, d double"), "placed")
    # at most MAX_ROUTES rows
    shape = {r["shard"]: r for r in placed.groupBy("shard").agg(
        F.count("*").alias("n"), F.max("d").alias("radius")).collect()}
    parts = {s: -(-r["n"] // SHARD_ROWS) for s, r in shape.items()}
    split = F.element_at(F.create_map(*[F.lit(v) for s in parts for v in (s, parts[s])]), F.col("shard"))

    def pages_of(key, t):
        shard, part = (x.as_py() for x in key)
        route = shared.value[shard]
        pages = build_pages(t.column("id").to_numpy(), matrix(t.column("x"), dim + 1), route)
        names = ("centre", "ids", "rows", "dist")
        return pa.table({
            "shard": pa.array([shard] * len(pages), pa.int32()),
            "part": pa.array([part] * len(pages), pa.int32()),
            "route": pa.array([route.tobytes()] * len(pages), pa.binary()),
            "radius": pa.array([p["radius"] for p in pages], pa.float64()),
            "up": pa.array([p["up"] for p in pages], pa.float64()),
            **{c: pa.array([np.ascontiguousarray(p[c]).tobytes() for p in pages], pa.binary())
               for c in names}})

    pages = written(
        placed.withColumn("part", F.pmod(F.xxhash64("id"), split).cast("int"))
        .groupBy("shard", "part").applyInArrow(
            pages_of, "shard int, part int, route binary, radius double, up double, "
                      "centre binary, ids binary, rows binary, dist binary"), "pages")

    asks = rows.where(F.col("asks")).groupBy("id").agg(F.min("v").alias("v"))
    asks = written(asks, "queries")
    order = np.array(sorted(shape), np.int64)
    radius = np.array([shape[s]["radius"] for s in order.tolist()])

    def plan(home: bool, brief: bool = False):
        """Rows (shard, id, q, bound), or the shard alone: shards that a query must visit.
        Its home shard has the nearest ball; the others are those that its bound reaches."""
        def run(batches):
            c = shared.value[order]
            for b in batches:
                q = _integers(b.column("v"), dim)
                d = _distances(np.hstack([q, np.zeros((len(q), 1))]), c)
                low = d - radius
                first = low.argmin(1)
                if home:
                    qi, si = np.arange(len(q)), first
                    bound = np.full(len(q), np.inf)
                else:
                    bound = b.column("bound").to_numpy(False)
                    reach = low <= (bound + _slack(top))[:, None]
                    reach[np.arange(len(q)), first] = False
                    qi, si = np.nonzero(reach)
                    bound = bound[qi]
                goal = pa.array(order[si].astype(np.int32))
                yield pa.RecordBatch.from_pydict({"shard": goal} if brief else {
                    "shard": goal, "id": pa.array(b.column("id").to_numpy(False)[qi]),
                    "q": lists(q[qi]), "bound": pa.array(bound)})
        return run

    def visit(queries: DataFrame, home: bool) -> DataFrame:
        """Results of ``queries`` in the shards that they reach; a page is sent once for
        every block of queries that reaches its shard, and not where none does."""
        # at most MAX_ROUTES rows
        blocks = {r["shard"]: -(-r["count"] // QUERY_BLOCK) for r in
                  queries.mapInArrow(plan(home, True), "shard int").groupBy("shard").count().collect()}
        if not blocks:
            return none.drop("rank")
        hops = queries.mapInArrow(plan(home), "shard int, id long, q array<double>, bound double")
        pick = F.element_at(F.create_map(*[F.lit(v) for s in blocks for v in (s, blocks[s])]), F.col("shard"))
        hops = hops.withColumn("block", F.pmod(F.xxhash64("id"), pick).cast("int")).withColumn(
            "part", F.explode(F.sequence(F.lit(0), split - 1)))
        held = (pages.where(F.col("shard").isin(list(blocks)))
                .withColumn("block", F.explode(F.sequence(F.lit(0), pick - 1))))
        held = held.withColumnsRenamed({"shard": "s2", "part": "p2", "block": "b2"})

        def find(one, two):
            if not one.num_rows or not two.num_rows:
                got, ids = [], np.zeros(0, np.int64)
            else:
                body, route = _pages_from(two, dim + 1)
                ids = one.column("id").to_numpy()
                q = matrix(one.column("q"), dim)
                got = search_shard(body, route, ids, q, one.column("bound").to_numpy(), top, k)
            return pa.table({"query_id": pa.array([int(ids[i]) for i, _, _ in got], pa.int64()),
                             "vec_id": pa.array([v for _, v, _ in got], pa.int64()),
                             "score": pa.array([s for _, _, s in got], pa.int64())})

        return (hops.groupBy("shard", "part", "block").cogroup(held.groupBy("s2", "p2", "b2"))
                .applyInArrow(find, "query_id long, vec_id long, score long"))

    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = written(visit(asks, True).withColumn("rank", F.row_number().over(w))
                    .where(F.col("rank") <= k), "home_results")
    kth = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), "score")
    bounded = asks.join(kth, "id", "left").withColumn("bound", F.when(
        F.col("score").isNull(), F.lit(float("inf"))).otherwise(
        F.sqrt(F.greatest(F.lit(0.0), _square("v") + F.lit(float(top)) - 2 * F.col("score").cast("double")))))
    bounded = written(bounded.drop("score"), "bounded")
    rest = visit(bounded, False)
    both = first.drop("rank").union(rest)
    return (both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
