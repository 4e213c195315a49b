"""Grouped ranking metrics: W1-W3, M1-M8, O5.

One pass computes every metric for every k:

1. groups above ``hot_rows`` rows are cut into ordered pieces by score
   (``ordering.cut_hot_groups``); all other groups are one piece;
2. per piece, a window gives the position by (score desc nulls last, tie) and
   another the rank of the label; one aggregate keeps rows, hits, the sum of
   the hits' positions, the labels of the first ``kmax`` positions and the
   ``kmax`` largest labels (lists of at most ``kmax``);
3. pieces of one group are combined: offsets by a window over pieces, first
   labels by concatenation in piece order, ideal top-k by merging the pieces'
   (top-k of a union is the top-k of the top-k's); without hot groups there is
   nothing to combine and the rows are shuffled once;
4. per-group metrics are array expressions over at most ``kmax`` values, then
   one global average per metric.

Rules (from the reference): NaN scores rank last; ties keep the tie column
order; precision divides by k even for short groups; groups without a
positive are left out of every binary metric, groups with IDCG = 0 out of
NDCG, GAUC uses groups with both classes and no tie averaging; an average
with no qualifying group is 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import HOT_ROWS, cut_hot_groups, order_by, ordered_index

REL, SCORE, TIE, HIT = "_rel", "_score", "_tie", "_hit"
METRICS = ("ndcg", "map", "mrr", "hitrate", "recall", "precision")


def _score_col(score: str) -> Column:
    s = F.col(score).cast("double")
    return F.when(F.isnan(s), F.lit(None).cast("double")).otherwise(s)


def _prep(df: DataFrame, group_cols: list[str], label: str, score: str, tie: str,
          thr: float) -> DataFrame:
    return df.select(*group_cols, F.col(label).cast("double").alias(REL),
                     _score_col(score).alias(SCORE), F.col(tie).alias(TIE),
                     (F.col(label).cast("double") >= F.lit(float(thr))).cast("int").alias(HIT))


_BY_SCORE = [(SCORE, False), (TIE, True)]


# ---------------------------------------------------------------------------
# Per-row positions
# ---------------------------------------------------------------------------

def rank_in_group(df: DataFrame, group_cols: list[str], score: str, tie: str,
                  out_col: str = "pos", hot_rows: int = HOT_ROWS) -> DataFrame:
    """0-based position by score desc (NaN last), ties by ``tie`` asc."""
    tmp = df.withColumn(SCORE, _score_col(score))
    return ordered_index(tmp, group_cols, [(SCORE, False), (tie, True)], out_col, hot_rows=hot_rows).drop(SCORE)


def running_hits(df: DataFrame, group_cols: list[str], label: str, score: str, tie: str,
                 thr: float, pos_col: str = "pos", cum_col: str = "cum_hits",
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hits (label >= thr) up to and including each row in score order."""
    tmp = df.withColumn(SCORE, _score_col(score)).withColumn(
        HIT, (F.col(label).cast("double") >= F.lit(float(thr))).cast("int"))
    out = ordered_index(tmp, group_cols, [(SCORE, False), (tie, True)], pos_col, hit_col=HIT,
                        cum_col=cum_col, hot_rows=hot_rows)
    return out.drop(SCORE, HIT)


def ideal_rank(df: DataFrame, group_cols: list[str], label: str, tie: str,
               out_col: str = "ideal_pos", hot_rows: int = HOT_ROWS) -> DataFrame:
    """0-based position by relevance desc within the group."""
    return ordered_index(df, group_cols, [(label, False), (tie, True)], out_col, hot_rows=hot_rows)


# ---------------------------------------------------------------------------
# One pass per piece
# ---------------------------------------------------------------------------

def group_stats(df: DataFrame, group_cols: list[str], label: str, score: str, tie: str,
                kmax: int, thr: float = 1.0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per group: size, n_pos, sum of positions of positives, first-k and ideal top-k labels."""
    prep, pieces = cut_hot_groups(_prep(df, group_cols, label, score, tie, thr), group_cols,
                                  _BY_SCORE, hot_rows)
    keys = [*group_cols, *pieces]
    part = Window.partitionBy(*(keys or [F.lit(0)]))
    rows = (prep.withColumn("_pos", F.row_number().over(part.orderBy(*order_by(_BY_SCORE))).cast("long") - 1)
            .withColumn("_best", F.row_number().over(part.orderBy(F.col(REL).desc_nulls_last()))))
    parts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(HIT).cast("long")).alias("_hits"),
        F.sum(F.col("_pos") * F.col(HIT)).alias("_sum_pos"),
        F.collect_list(F.when(F.col("_pos") < kmax, F.struct("_pos", REL))).alias("_first"),
        F.collect_list(F.when(F.col("_best") <= kmax, F.col(REL))).alias("_top"))
    if pieces:
        w = Window.partitionBy(*(group_cols or [F.lit(0)])).orderBy(
            *[F.col(p).asc_nulls_first() for p in pieces]).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_n").over(w), F.lit(0))
        parts = parts.withColumn("_before", before).groupBy(*group_cols).agg(
            F.sum("_n").alias("_n"), F.sum("_hits").alias("_hits"),
            F.sum(F.col("_sum_pos") + F.col("_before") * F.col("_hits")).alias("_sum_pos"),
            F.flatten(F.collect_list(F.when(F.col("_before") < kmax, F.transform("_first", lambda x: F.struct(
                (x["_pos"] + F.col("_before")).alias("_pos"), x[REL].alias(REL)))))).alias("_first"),
            F.flatten(F.collect_list("_top")).alias("_top"))
    first = F.slice(F.transform(F.array_sort("_first"), lambda x: x[REL]), 1, kmax)
    ideal = F.slice(F.sort_array("_top", asc=False), 1, kmax)
    return parts.select(*group_cols, F.col("_n").alias("size"), F.col("_hits").alias("n_pos"),
                        F.col("_sum_pos").alias("sum_pos"), first.alias("first_rel"),
                        ideal.alias("ideal_rel"))


# ---------------------------------------------------------------------------
# Per-group metric expressions over the first-k arrays
# ---------------------------------------------------------------------------

def _gain(x: Column, gain: str) -> Column:
    return F.pow(F.lit(2.0), x) - F.lit(1.0) if gain == "exp" else x


def _dcg(arr: Column, k: int, gain: str) -> Column:
    terms = F.transform(F.slice(arr, 1, k), lambda x, i: _gain(x, gain) / F.log2(i.cast("double") + 2.0))
    return F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)


def _hits_at(arr: Column, k: int, thr: float) -> Column:
    return F.size(F.filter(F.slice(arr, 1, k), lambda x: x >= F.lit(thr))).cast("double")


def group_metric_cols(k: int, thr: float, gain: str = "exp") -> dict[str, tuple[Column, Column]]:
    """metric -> (per-group value, validity) for one k."""
    first, ideal = F.col("first_rel"), F.col("ideal_rel")
    n_pos = F.col("n_pos").cast("double")
    top = F.slice(first, 1, k)
    dcg, idcg = _dcg(first, k, gain), _dcg(ideal, k, gain)
    hits = _hits_at(first, k, thr)
    ap_terms = F.transform(top, lambda x, i: F.when(
        x >= F.lit(thr),
        F.size(F.filter(F.slice(top, 1, i + 1), lambda y: y >= F.lit(thr))).cast("double")
        / (i.cast("double") + 1.0)).otherwise(F.lit(0.0)))
    ap = F.aggregate(ap_terms, F.lit(0.0), lambda a, b: a + b) / F.least(n_pos, F.lit(float(k)))
    first_hit = F.array_position(F.transform(top, lambda x: x >= F.lit(thr)), True)
    rr = F.when(first_hit > 0, F.lit(1.0) / first_hit.cast("double")).otherwise(F.lit(0.0))
    has_pos = F.col("n_pos") > 0
    return {
        "ndcg": (dcg / idcg, idcg > 0),
        "map": (ap, has_pos),
        "mrr": (rr, has_pos),
        "hitrate": ((hits > 0).cast("double"), has_pos),
        "recall": (hits / n_pos, has_pos),
        "precision": (hits / F.lit(float(k)), has_pos),
    }


def gauc_cols() -> tuple[Column, Column]:
    """M7 per group: Mann-Whitney AUC from the sum of positive positions; valid with both classes."""
    size = F.col("size").cast("double")
    p = F.col("n_pos").cast("double")
    neg = size - p
    rank_sum = p * size - F.col("sum_pos").cast("double")
    auc = (rank_sum - p * (p + 1.0) / 2.0) / (p * neg)
    return auc, (F.col("n_pos") > 0) & (F.col("size") > F.col("n_pos"))


def _avg_valid(value: Column, valid: Column) -> Column:
    return F.coalesce(F.avg(F.when(valid, value)), F.lit(0.0))


def ranking_metrics(df: DataFrame, group_cols: list[str], label: str, score: str, tie: str,
                    ks=(5, 10, 20), thr: float = 1.0, by: list[str] | None = None,
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """M8: all metrics for all ``ks`` plus ``gauc`` and ``n_groups``, one row per ``by``.

    ``by`` (e.g. ``["split"]``) evaluates several slices in the same pass; the
    slice columns are part of the group key.
    """
    by = list(by or [])
    keys = by + [g for g in group_cols if g not in by]
    gs = group_stats(df, keys, label, score, tie, max(ks), thr, hot_rows)
    aggs = []
    for k in ks:
        cols = group_metric_cols(k, thr)
        for m in METRICS:
            v, ok = cols[m]
            aggs.append(_avg_valid(v, ok).alias(f"{m}_at_{k}"))
    auc, ok = gauc_cols()
    aggs.append(_avg_valid(auc, ok).alias("gauc"))
    aggs.append(F.count(F.lit(1)).alias("n_groups"))
    return gs.groupBy(*by).agg(*aggs) if by else gs.agg(*aggs)


def single_metric(df: DataFrame, metric: str, group_cols: list[str], label: str, score: str,
                  tie: str, k: int | None = None, thr: float = 1.0, gain: str = "exp",
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """M1-M7 one at a time (``metric`` in METRICS or ``gauc``)."""
    gs = group_stats(df, group_cols, label, score, tie, k or 1, thr, hot_rows)
    if metric == "gauc":
        v, ok = gauc_cols()
        return gs.agg(_avg_valid(v, ok).alias("gauc"))
    v, ok = group_metric_cols(int(k), thr, gain)[metric]
    name = f"{metric}_linear_at_{k}" if (metric == "ndcg" and gain != "exp") else f"{metric}_at_{k}"
    return gs.agg(_avg_valid(v, ok).alias(name))
