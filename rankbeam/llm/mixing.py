"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted in tokens per cell (source, language, topic). Raking
multiplies the cells' weights by one factor per value of each dimension in
turn until the weighted token shares meet the target shares of all three
dimensions. A document's inclusion probability is its cell's weight times a
common rate, at most 1, with the rate set so that the expected number of kept
tokens is the budget; a hash of its id decides.

Only the cell table goes through the raking. Up to ``SMALL_CELLS`` cells (a
checked count) it is raked as arrays on the driver and joined back by
broadcast; a larger table is raked as a DataFrame, written to the shared folder
every round, and joined back by a shuffled join (split where skewed). Both ways
give the same weights.

Defined results: a null source or language is the value ``?``; a null text
counts no tokens; cells without tokens keep probability 0 unless the budget is
the whole input (then 1 for all); a target value that no document has is left out and
the other targets of that dimension are scaled up; targets that no weights can
meet together end after ``max_rounds`` with the last fit; rows with the same
id share one decision, a null id is hashed like any value; an empty table
gives no rows. Columns besides the named ones pass untouched.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, shield, written

DIMS = ("source", "lang", "topic")
#: The largest cell table that is raked on the driver and broadcast.
SMALL_CELLS = 100_000
#: Default targets: each value's share of tokens to this power, scaled to 1.
EXPONENTS = {"source": 0.5, "lang": 0.7, "topic": 0.8}


def token_count(text: Column) -> Column:
    """Words as runs between single spaces or line breaks: separators plus one."""
    t = F.coalesce(text, F.lit(""))
    seps = F.length(t) - F.length(F.translate(t, " \n", ""))
    return F.when(F.length(t) > 0, seps + 1).otherwise(0).cast("long")


def topic(text: Column) -> Column:
    """The form of a text, by marks that stand in it: table, notice, keyed or prose."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(F.contains(t, F.lit(" | ")), "table")
            .when(F.lower(t).rlike("licen[sc]e|copyright|all rights reserved"), "notice")
            .when(t.rlike("[=:] ?[\"']?[0-9a-f]{12,}|https?://"), "keyed")
            .otherwise("prose"))


def _keyed(docs: DataFrame) -> DataFrame:
    """Cell keys and token counts as ``__`` columns beside the row's own."""
    cols = set(docs.columns)
    if "topic" in cols:
        form = F.coalesce(F.col("topic").cast("string"), F.lit("?"))
    else:
        form = topic(F.col("text"))
    return docs.withColumns({
        "__source": F.coalesce(F.col("source").cast("string"), F.lit("?")),
        "__lang": F.coalesce(F.col("lang").cast("string"), F.lit("?")),
        "__topic": form, "__tokens": token_count(F.col("text"))})


def rake_arrays(tokens: np.ndarray, codes: list[np.ndarray], goals: list[np.ndarray],
                max_rounds: int, tolerance: float) -> np.ndarray:
    """Raked token shares of cells: ``codes`` has each cell's value per dimension."""
    w = tokens.astype(float)
    for _ in range(max_rounds):
        worst = 0.0
        for code, goal in zip(codes, goals, strict=True):
            s = np.bincount(code, w, len(goal))
            worst = max(worst, float(np.abs(s - goal).sum()))
            w = w * np.divide(goal, s, out=np.zeros(len(goal)), where=s > 0)[code]
        if worst < tolerance:
            break
    return w


def _rake_small(cells: DataFrame, targets: Mapping, max_rounds: int, tolerance: float) -> DataFrame:
    rows = cells.orderBy(*DIMS).collect()
    tokens = np.array([r["tokens"] for r in rows], np.int64)
    codes, goals = [], []
    for d in DIMS:
        values = sorted({r[d] for r in rows})
        at = {v: i for i, v in enumerate(values)}
        codes.append(np.array([at[r[d]] for r in rows], np.int64))
        want = targets.get(d, EXPONENTS[d])
        if isinstance(want, Mapping):
            g = np.array([float(want.get(v, 0.0)) for v in values])
        else:
            g = np.bincount(codes[-1], tokens, len(values)) ** float(want)
        goals.append(g / (g.sum() or 1.0))
    w = rake_arrays(tokens, codes, goals, max_rounds, tolerance) if rows else tokens.astype(float)
    return cells.sparkSession.createDataFrame(
        [(*(r[d] for d in DIMS), r["tokens"], float(x), float(x) / r["tokens"])
         for r, x in zip(rows, w, strict=True)],
        "source string, lang string, topic string, tokens long, w double, weight double")


def rake(cells: DataFrame, targets: Mapping[str, Mapping[str, float] | float],
         max_rounds: int = 30, tolerance: float = 1e-4, small: bool = False) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``: raked tokens per token.

    ``targets``: for each dimension the shares of its values, or an exponent
    that flattens the shares found in the data. ``small``: rake on the driver.
    """
    if small:
        return _rake_small(cells.where("tokens > 0"), targets, max_rounds, tolerance)
    spark = cells.sparkSession
    cells = written(cells.where("tokens > 0").withColumn("w", F.col("tokens").cast("double")), "cells")
    goal = {}
    for d in DIMS:
        have = cells.groupBy(d).agg(F.sum("tokens").alias("t"))
        want = targets.get(d, EXPONENTS[d])
        if isinstance(want, Mapping):
            named = spark.createDataFrame([(k, float(v)) for k, v in want.items()],
                                          f"{d} string, g double")
            have = have.join(named, d, "left").select(d, F.coalesce("g", F.lit(0.0)).alias("g"))
        else:
            have = have.select(d, F.pow(F.col("t").cast("double"), F.lit(float(want))).alias("g"))
        total = have.agg(F.sum("g")).first()[0] or 1.0
        goal[d] = written(have.select(d, (F.col("g") / F.lit(total)).alias("g")), f"goal_{d}")
    for _ in range(max_rounds):
        worst = 0.0
        for d in DIMS:
            sums = (cells.groupBy(d).agg(F.sum("w").alias("s")).join(goal[d], d)
                    .select(d, "s", "g"))
            total, gap = sums.agg(F.sum("s"), F.sum(F.abs(F.col("s") - F.col("g")))).first()
            total, gap = total or 0.0, gap or 0.0
            worst = max(worst, gap)
            # the first round starts from tokens, so its gap counts as far off
            factor = sums.select(d, F.when(F.col("s") > 0, F.col("g") / F.col("s"))
                                 .otherwise(0.0).alias("f"))
            cells = cells.join(factor, d).withColumn("w", F.col("w") * F.col("f")).drop("f")
        cells = written(cells, "cells")
        if worst < tolerance:
            break
    return cells.withColumn("weight", F.col("w") / F.col("tokens"))


def _rate(raked: DataFrame, budget: float) -> float:
    """The rate c with sum(tokens * min(1, c * weight)) = budget * sum(tokens)."""
    levels = raked.groupBy("weight").agg(F.sum("tokens").alias("tokens"), F.sum("w").alias("w"))
    total = raked.agg(F.sum("tokens")).first()[0] or 0
    want = budget * total
    rate = want
    if levels.count() <= SMALL_CELLS:
        weight, tokens, w = (np.array(x, float) for x in zip(
            *[(r["weight"], r["tokens"], r["w"]) for r in levels.collect()], strict=True)) \
            if total else (np.zeros(0),) * 3
        for _ in range(1000):
            full = weight * rate >= 1
            rest = w[~full].sum()
            new = max(0.0, want - tokens[full].sum()) / rest if rest else rate
            if new - rate <= 1e-12 * rate:
                break
            rate = new
        return rate
    for _ in range(40):
        full, rest = raked.agg(
            F.sum(F.when(F.col("weight") * rate >= 1, F.col("tokens")).otherwise(0)),
            F.sum(F.when(F.col("weight") * rate < 1, F.col("w")).otherwise(0.0))).first()
        if not rest or full is None:
            break
        new = max(0.0, want - full) / rest
        if abs(new - rate) <= 1e-9 * max(1.0, rate):
            break
        rate = max(new, rate)
    return rate


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float] | float] | None = None,
        budget: float = 0.5, seed: int = 7) -> DataFrame:
    """``docs`` with ``topic_found``, ``tokens``, ``weight``, ``prob`` and ``kept`` added."""
    prepare(docs.sparkSession)
    docs = docs.drop("topic_found", "tokens", "weight", "prob", "kept")
    keyed = _keyed(docs)
    cells = keyed.groupBy(*[F.col(f"__{d}").alias(d) for d in DIMS]).agg(
        F.sum("__tokens").alias("tokens"))
    cells = written(cells, "cells")
    small = cells.count() <= SMALL_CELLS
    raked = rake(cells, targets or {}, small=small)
    if budget >= 1:
        probs = raked.select(*DIMS, "weight", F.lit(1.0).alias("prob"))
    else:
        rate = _rate(raked, budget)
        probs = raked.select(*DIMS, "weight",
                             F.least(F.lit(1.0), F.col("weight") * rate).alias("prob"))
    probs = written(probs.select(*[F.col(d).alias(f"__{d}") for d in DIMS], "weight", "prob"), "probs")
    if small:
        probs = F.broadcast(probs)
    joined = keyed.join(probs, [f"__{d}" for d in DIMS], "left")
    draw = (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 40)) / F.lit(float(1 << 40)))
    none = 1.0 if budget >= 1 else 0.0
    out = joined.withColumns({
        "topic_found": F.col("__topic"), "tokens": F.col("__tokens"),
        "weight": F.coalesce("weight", F.lit(0.0)), "prob": F.coalesce("prob", F.lit(none))})
    out = out.withColumn("kept", draw < F.col("prob"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns],
                      "topic_found", "tokens", "weight", "prob", "kept")


def keep_mixed(docs: DataFrame, targets=None, budget: float = 0.5) -> DataFrame:
    """The sampled rows of ``docs``; all its columns, whatever their names, stay as they are."""
    hidden, restore = shield(docs, ("topic_found", "tokens", "weight", "prob", "kept"))
    return restore(mix(hidden, targets, budget).where("kept"))
