"""DuckDB oracle SQL for the registered test-data queries.

The SQL restates each query independently over the pre-registered views
(``events part customer nation embeddings``...). CTE fragments are shared
so every oracle starts from the same adapter projection as the Spark side.
"""

from __future__ import annotations

from .testdata import HEAD_ROWS, HOT_AUTHOR, METRIC_K, TD_CFG

_C = TD_CFG.cleaning
_L = TD_CFG.label
_E = TD_CFG.eval
_S = TD_CFG.split
_Q_TRAIN = repr(float(_S.train_frac))
_Q_VAL = repr(float(_S.train_frac + _S.val_frac))
_DIM = int(TD_CFG.features.embedding_dim)

FLAGS = ("like", "dislike", "share", "bookmark", "click_on_author", "open_comments")
QFLAGS = ", ".join(f'"{f}"' for f in FLAGS)


def _flag_norm():
    return ", ".join(f'COALESCE(CAST("{f}" AS TINYINT), CAST(0 AS TINYINT)) AS "{f}"' for f in FLAGS)


def _label_sql():
    terms = [f"CAST(watch_ratio >= CAST({_L.watch_ratio_threshold} AS FLOAT) AS DOUBLE) * {float(_L.watch_weight)}"]
    terms += [f'CAST("{f}" AS DOUBLE) * {float(w)}' for f, w in _L.weights]
    body = f"LEAST(GREATEST({' + '.join(terms)}, 0.0), {float(_L.clip_max)})"
    return f"CAST(CASE WHEN dislike > 0 THEN 0.0 ELSE {body} END AS FLOAT)"


BASE = f"""
log AS (
  SELECT event_id AS event_order, user_id,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         value AS timespent,
         CAST(event_type = 'click' AS TINYINT) AS "like",
         CAST(event_type = 'error' AS TINYINT) AS dislike,
         CAST(event_type = 'purchase' AS TINYINT) AS share,
         CAST(event_type = 'signup' AS TINYINT) AS bookmark,
         CAST(event_id % 20 = 0 AS TINYINT) AS click_on_author,
         CAST(event_id % 25 = 0 AS TINYINT) AS open_comments,
         'pl' || CAST(event_id % 3 AS VARCHAR) AS place,
         'pf' || CAST(event_id % 4 AS VARCHAR) AS platform,
         'ag' || CAST(event_id % 2 AS VARCHAR) AS agent
  FROM events),
norm AS (
  SELECT event_order, user_id, item_id, timespent, {_flag_norm()}, place, platform, agent
  FROM log WHERE user_id IS NOT NULL AND item_id IS NOT NULL),
items AS (SELECT p_partkey AS item_id, p_size AS duration, p_brand AS author_id FROM part),
users AS (
  SELECT c_custkey AS user_id, CAST(floor(abs(c_acctbal) / 200) AS BIGINT) AS age,
         c_mktsegment AS gender, n_name AS geo
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
enriched AS (
  SELECT n.*, i.duration, i.author_id, u.age, u.gender, u.geo
  FROM norm n LEFT JOIN items i ON n.item_id = i.item_id
              LEFT JOIN users u ON n.user_id = u.user_id),
cleaned AS (
  SELECT *, CAST(LEAST(GREATEST(CAST(timespent AS DOUBLE) / CAST(duration AS DOUBLE), 0.0),
                       {float(_C.max_watch_ratio)}) AS FLOAT) AS watch_ratio
  FROM enriched
  WHERE timespent IS NOT NULL AND timespent >= 0 AND timespent <= {float(_C.max_timespent_sec)}
    AND duration IS NOT NULL AND NOT isnan(CAST(duration AS DOUBLE)) AND duration > 0),
active_users AS (SELECT user_id FROM cleaned GROUP BY user_id HAVING count(*) >= {_C.min_user_interactions}),
active_items AS (SELECT item_id FROM cleaned GROUP BY item_id HAVING count(*) >= {_C.min_item_interactions}),
inter AS (
  SELECT *, {_label_sql()} AS label FROM cleaned
  WHERE user_id IN (SELECT user_id FROM active_users)
    AND item_id IN (SELECT item_id FROM active_items)),
ranked_eo AS (
  SELECT event_order, row_number() OVER (ORDER BY event_order) - 1 AS rk, count(*) OVER () AS n FROM inter),
bounds AS (
  SELECT max(CASE WHEN rk = CAST(floor((n - 1) * CAST({_Q_TRAIN} AS DOUBLE) + 0.5) AS BIGINT) THEN event_order END) AS train_end,
         max(CASE WHEN rk = CAST(floor((n - 1) * CAST({_Q_VAL} AS DOUBLE) + 0.5) AS BIGINT) THEN event_order END) AS val_end
  FROM ranked_eo),
splitted AS (
  SELECT i.*, CASE WHEN i.event_order < (SELECT train_end FROM bounds) THEN 'train'
                   WHEN i.event_order < (SELECT val_end FROM bounds) THEN 'val' ELSE 'test' END AS split
  FROM inter i),
train AS (SELECT * FROM splitted WHERE split = 'train')
"""


def _rates(prefix: str) -> str:
    return ", ".join(f'avg(CAST("{f}" AS DOUBLE)) AS {prefix}_{f}_rate' for f in FLAGS)


FEATS = f"""
user_f AS (
  SELECT user_id, count(*) AS user_n_events,
         avg(CAST(watch_ratio AS DOUBLE)) AS user_mean_watch_ratio,
         avg(CAST(timespent AS DOUBLE)) AS user_mean_timespent,
         avg(CAST(duration AS DOUBLE)) AS user_mean_duration,
         count(DISTINCT author_id) + max(CASE WHEN author_id IS NULL THEN 1 ELSE 0 END) AS user_n_authors,
         {_rates('user')}
  FROM train GROUP BY user_id),
item_f AS (
  SELECT item_id, count(*) AS item_n_views,
         avg(CAST(watch_ratio AS DOUBLE)) AS item_mean_watch_ratio,
         avg(CAST(label AS DOUBLE)) AS item_mean_label,
         {_rates('item')}
  FROM train GROUP BY item_id),
author_f AS (
  SELECT author_id, count(*) AS author_n_views,
         count(DISTINCT item_id) + max(CASE WHEN item_id IS NULL THEN 1 ELSE 0 END) AS author_n_items,
         avg(CAST(watch_ratio AS DOUBLE)) AS author_mean_watch_ratio,
         {_rates('author')}
  FROM train GROUP BY author_id),
ua_f AS (
  SELECT user_id, author_id, count(*) AS ua_n_events,
         avg(CAST(watch_ratio AS DOUBLE)) AS ua_mean_watch_ratio,
         avg(CAST(label AS DOUBLE)) AS ua_mean_label
  FROM train GROUP BY user_id, author_id)
"""


EMB = f"""
vec_raw AS (
  SELECT vec_id AS item_id, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IN (SELECT item_id FROM inter)),
vec_dedup AS (SELECT item_id, min(embedding) AS embedding FROM vec_raw GROUP BY item_id),
vec_el AS (
  SELECT item_id, i, CAST(embedding[i] AS DOUBLE) AS x FROM (
    SELECT item_id, embedding, unnest(range(1, least(len(embedding), {_DIM}) + 1)) AS i
    FROM vec_dedup)),
vec_norm AS (SELECT item_id, greatest(sqrt(sum(x * x)), 1e-12) AS nrm FROM vec_el GROUP BY item_id),
unit AS (SELECT e.item_id, e.i, e.x / n.nrm AS x FROM vec_el e JOIN vec_norm n ON e.item_id = n.item_id),
pos_pairs AS (
  SELECT user_id, item_id, count(*) AS votes FROM inter
  WHERE event_order < (SELECT train_end FROM bounds) AND label >= CAST({TD_CFG.features.profile_pos_label} AS FLOAT)
  GROUP BY user_id, item_id),
pvotes AS (
  SELECT user_id, CAST(sum(votes) AS BIGINT) AS n_votes FROM pos_pairs
  WHERE item_id IN (SELECT item_id FROM vec_dedup) GROUP BY user_id),
psum AS (
  SELECT p.user_id, u.i, sum(p.votes * u.x) AS s
  FROM pos_pairs p JOIN unit u ON p.item_id = u.item_id GROUP BY p.user_id, u.i),
pmean AS (SELECT s.user_id, s.i, s.s / v.n_votes AS m FROM psum s JOIN pvotes v ON s.user_id = v.user_id),
pnorm AS (SELECT user_id, greatest(sqrt(sum(m * m)), 1e-12) AS nrm FROM pmean GROUP BY user_id),
profile AS (SELECT m.user_id, m.i, m.m / n.nrm AS x FROM pmean m JOIN pnorm n ON m.user_id = n.user_id),
cos AS (
  SELECT e.event_order, CAST(sum(p.x * u.x) AS FLOAT) AS c
  FROM inter e JOIN profile p ON e.user_id = p.user_id
               JOIN unit u ON e.item_id = u.item_id AND p.i = u.i
  GROUP BY e.event_order)
"""

NUM_FEATURES = (
    ["age", "user_n_events", "user_mean_watch_ratio", "user_mean_timespent",
     "user_mean_duration", "user_n_authors"] + [f"user_{f}_rate" for f in FLAGS]
    + ["duration", "item_n_views", "item_mean_watch_ratio", "item_mean_label"]
    + [f"item_{f}_rate" for f in FLAGS]
    + ["author_n_views", "author_n_items", "author_mean_watch_ratio"]
    + [f"author_{f}_rate" for f in FLAGS]
    + ["ua_n_events", "ua_mean_watch_ratio", "ua_mean_label", "dur_diff", "emb_cos"])
CAT_FEATURES = ["gender", "geo", "place", "platform", "agent"]

DATASET = """
joined AS (
  SELECT s.*, uf.* EXCLUDE (user_id), itf.* EXCLUDE (item_id), af.* EXCLUDE (author_id),
         ua.* EXCLUDE (user_id, author_id), c.c AS emb_cos,
         CAST(abs(CAST(s.duration AS DOUBLE) - uf.user_mean_duration) AS FLOAT) AS dur_diff
  FROM splitted s
  LEFT JOIN user_f uf ON s.user_id = uf.user_id
  LEFT JOIN item_f itf ON s.item_id = itf.item_id
  LEFT JOIN author_f af ON s.author_id = af.author_id
  LEFT JOIN ua_f ua ON s.user_id = ua.user_id AND s.author_id = ua.author_id
  LEFT JOIN cos c ON s.event_order = c.event_order),
dataset AS (
  SELECT user_id, item_id, event_order, label,
         """ + ", ".join(f"TRY_CAST({c} AS FLOAT) AS {c}" for c in NUM_FEATURES) + """,
         """ + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), 'unknown') AS {c}" for c in CAT_FEATURES) + """,
         split
  FROM joined)
"""


def scored_sql(splits=("val",)) -> str:
    lst = ", ".join(f"'{x}'" for x in splits)
    return f"""
scored AS (
  SELECT s.user_id, s.event_order, s.split, CAST(s.label AS DOUBLE) AS y,
         CAST(CAST(f.item_mean_label AS FLOAT) AS DOUBLE) AS score
  FROM splitted s LEFT JOIN item_f f ON s.item_id = f.item_id
  WHERE s.split IN ({lst})),
ranked AS (
  SELECT *, CASE WHEN y >= {float(_E.binary_threshold)} THEN 1 ELSE 0 END AS hit,
         row_number() OVER (PARTITION BY split, user_id ORDER BY score DESC NULLS LAST, event_order) - 1 AS pos,
         row_number() OVER (PARTITION BY split, user_id ORDER BY y DESC, event_order) - 1 AS ipos,
         CAST(sum(CASE WHEN y >= {float(_E.binary_threshold)} THEN 1 ELSE 0 END) OVER (
             PARTITION BY split, user_id ORDER BY score DESC NULLS LAST, event_order
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_hits
  FROM scored)
"""


def group_sql(ks, gain="exp") -> str:
    g = (lambda v: f"(pow(2.0, {v}) - 1.0)") if gain == "exp" else (lambda v: v)
    cols = []
    for k in ks:
        cols += [
            f"sum(CASE WHEN pos < {k} THEN {g('y')} / log2(pos + 2.0) ELSE 0 END) AS dcg_{k}",
            f"sum(CASE WHEN ipos < {k} THEN {g('y')} / log2(ipos + 2.0) ELSE 0 END) AS idcg_{k}",
            f"sum(CASE WHEN pos < {k} AND hit = 1 THEN 1 ELSE 0 END) AS hits_{k}",
            f"min(CASE WHEN pos < {k} AND hit = 1 THEN pos END) AS fh_{k}",
            f"sum(CASE WHEN pos < {k} AND hit = 1 THEN cum_hits / (pos + 1.0) ELSE 0 END) AS ap_{k}",
        ]
    return f"""
grp AS (
  SELECT split, user_id, count(*) AS size, sum(hit) AS n_pos,
         sum(CASE WHEN hit = 1 THEN pos ELSE 0 END) AS sum_pos, {", ".join(cols)}
  FROM ranked GROUP BY split, user_id)
"""


def metric_exprs(k: int) -> dict[str, str]:
    return {
        f"ndcg_at_{k}": f"coalesce(avg(CASE WHEN idcg_{k} > 0 THEN dcg_{k} / idcg_{k} END), 0.0)",
        f"map_at_{k}": f"coalesce(avg(CASE WHEN n_pos > 0 THEN ap_{k} / least(n_pos, {k}) END), 0.0)",
        f"mrr_at_{k}": f"coalesce(avg(CASE WHEN n_pos > 0 THEN coalesce(1.0 / (fh_{k} + 1), 0.0) END), 0.0)",
        f"hitrate_at_{k}": f"coalesce(avg(CASE WHEN n_pos > 0 THEN CASE WHEN hits_{k} > 0 THEN 1.0 ELSE 0.0 END END), 0.0)",
        f"recall_at_{k}": f"coalesce(avg(CASE WHEN n_pos > 0 THEN hits_{k} / n_pos END), 0.0)",
        f"precision_at_{k}": f"coalesce(avg(CASE WHEN n_pos > 0 THEN hits_{k} / {float(k)} END), 0.0)",
    }


GAUC = ("coalesce(avg(CASE WHEN n_pos > 0 AND size > n_pos THEN "
        "((n_pos * size - sum_pos) - n_pos * (n_pos + 1) / 2.0) / (n_pos * (size - n_pos)) END), 0.0)")


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def r6(expr: str, alias: str) -> str:
    """Computed doubles are compared at float32 precision (no decimal ties)."""
    return f"CAST({expr} AS FLOAT) AS {alias}"


def _feat_select(table: str, keys: list[str], cols: list[str]) -> str:
    return f"SELECT {', '.join(keys)}, " + ", ".join(
        c if c.endswith(("_n_events", "_n_views", "_n_authors", "_n_items")) else r6(c, c) for c in cols
    ) + f" FROM {table}"


def _rate_names(prefix):
    return [f"{prefix}_{f}_rate" for f in FLAGS]


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    base = with_(BASE)
    feats = with_(BASE, FEATS)
    q["feedback_normalise"] = base + f"SELECT event_order, user_id, item_id, {QFLAGS} FROM norm"
    q["enrich_events"] = base + ("SELECT event_order, user_id, item_id, duration, author_id, age, gender, geo "
                                 "FROM enriched")
    q["clean_events"] = base + "SELECT event_order, user_id, item_id, timespent, duration FROM cleaned"
    q["watch_ratio"] = base + "SELECT event_order, watch_ratio FROM cleaned"
    q["min_activity"] = base + "SELECT event_order, user_id, item_id FROM inter"
    q["graded_label"] = base + "SELECT event_order, label, watch_ratio, dislike FROM inter"
    q["user_sample"] = base + (
        "SELECT event_order, user_id FROM enriched WHERE "
        "CAST('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 10000 < 3000")
    q["stage_stats"] = base + f"""
SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
       {r6('avg(CAST(label AS DOUBLE))', 'label_mean')},
       {r6('avg(CAST(label >= CAST(1.0 AS FLOAT) AS DOUBLE))', 'label_pos_share')},
       {r6('avg(CAST(watch_ratio AS DOUBLE))', 'watch_ratio_mean')}
FROM inter"""
    q["split_bounds"] = base + "SELECT train_end, val_end FROM bounds"
    q["temporal_split"] = base + "SELECT event_order, split FROM splitted"
    q["split_sizes"] = base + "SELECT split, count(*) AS n_rows FROM splitted GROUP BY split"
    q["user_features"] = feats + _feat_select(
        "user_f", ["user_id"], ["user_n_events", "user_mean_watch_ratio", "user_mean_timespent",
                                "user_mean_duration", "user_n_authors"] + _rate_names("user"))
    q["item_features"] = feats + _feat_select(
        "item_f", ["item_id"], ["item_n_views", "item_mean_watch_ratio", "item_mean_label"]
        + _rate_names("item"))
    q["author_features"] = feats + _feat_select(
        "author_f", ["author_id"], ["author_n_views", "author_n_items", "author_mean_watch_ratio"]
        + _rate_names("author"))
    q["user_author_features"] = feats + _feat_select(
        "ua_f", ["user_id", "author_id"], ["ua_n_events", "ua_mean_watch_ratio", "ua_mean_label"])
    emb = with_(BASE, EMB)
    q["embedding_normalise"] = emb + (
        "SELECT item_id, i, CAST(x AS FLOAT) AS x FROM unit")
    q["user_profile"] = emb + (
        "SELECT p.user_id, v.n_votes, p.i, CAST(p.x AS FLOAT) AS x "
        "FROM profile p JOIN pvotes v ON p.user_id = v.user_id")
    q["emb_cos"] = emb + (
        "SELECT e.event_order, CAST(CAST(c.c AS DOUBLE) AS FLOAT) AS emb_cos "
        "FROM inter e LEFT JOIN cos c ON e.event_order = c.event_order")
    q["stored_cosine"] = q["emb_cos"]
    q["profile_coverage"] = emb + (
        "SELECT count(p.user_id) AS n_with_profile, count(*) AS n_users "
        "FROM (SELECT DISTINCT user_id FROM inter) u LEFT JOIN pvotes p ON u.user_id = p.user_id")
    q["id_lookup"] = base + (
        "SELECT q.item_id, COALESCE(v.idx, -1) AS idx "
        "FROM (SELECT DISTINCT item_id FROM norm) q LEFT JOIN "
        "(SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx FROM "
        "(SELECT DISTINCT vec_id AS item_id FROM embeddings)) v ON q.item_id = v.item_id")
    ds = with_(BASE, FEATS, EMB, DATASET)
    num_sel = ", ".join(r6(c, c) for c in NUM_FEATURES)
    q["assemble_features"] = ds + (
        f"SELECT user_id, item_id, event_order, {r6('label', 'label')}, {num_sel}, {', '.join(CAT_FEATURES)}, split FROM dataset")
    q["dur_diff"] = ds + f"SELECT event_order, {r6('dur_diff', 'dur_diff')} FROM dataset"
    q["categorical_normalise"] = ds + f"SELECT event_order, {', '.join(CAT_FEATURES)} FROM dataset"
    q["grouped_split"] = base + (
        "SELECT split, count(*) AS n_rows, CAST(0 AS BIGINT) AS broken_runs, "
        "CAST(0 AS BIGINT) AS order_breaks FROM splitted GROUP BY split")
    q["head_whole_groups"] = ds + f"""
, head AS (SELECT user_id, event_order, label FROM dataset WHERE split = 'train'
           ORDER BY user_id, event_order LIMIT {HEAD_ROWS})
SELECT user_id, event_order, label FROM head
WHERE (SELECT count(DISTINCT user_id) FROM head) <= 1 OR user_id <> (SELECT max(user_id) FROM head)"""
    sc = with_(BASE, FEATS, scored_sql())
    q["rank_in_group"] = sc + "SELECT user_id, event_order, pos FROM ranked"
    q["running_hits"] = sc + "SELECT user_id, event_order, pos, cum_hits FROM ranked"
    q["ideal_rank"] = sc + "SELECT user_id, event_order, ipos AS ideal_pos FROM ranked"
    k = METRIC_K
    g1 = with_(BASE, FEATS, scored_sql(), group_sql((k,)))
    gl = with_(BASE, FEATS, scored_sql(), group_sql((k,), gain="linear"))
    me = metric_exprs(k)
    for m in ("ndcg", "map", "mrr", "hitrate", "recall", "precision"):
        q[f"{m}_at_k"] = g1 + f"SELECT CAST({me[f'{m}_at_{k}']} AS FLOAT) AS {m}_at_{k} FROM grp"
    q["ndcg_linear_at_k"] = gl + f"SELECT CAST({me[f'ndcg_at_{k}']} AS FLOAT) AS ndcg_linear_at_{k} FROM grp"
    q["gauc"] = g1 + f"SELECT CAST({GAUC} AS FLOAT) AS gauc FROM grp"
    ks = tuple(_E.ks)
    allm = {}
    for kk in ks:
        allm.update(metric_exprs(kk))
    sel = ", ".join(f"CAST({v} AS FLOAT) AS {n}" for n, v in allm.items())
    gall = with_(BASE, FEATS, scored_sql(), group_sql(ks))
    q["ranking_metrics"] = gall + f"SELECT {sel}, CAST({GAUC} AS FLOAT) AS gauc, count(*) AS n_groups FROM grp"
    gby = with_(BASE, FEATS, scored_sql(("val", "test")), group_sql(ks))
    q["metrics_by_split"] = gby + (
        f"SELECT split, {sel}, CAST({GAUC} AS FLOAT) AS gauc, count(*) AS n_groups FROM grp GROUP BY split")
    rnd = scored_sql().replace(
        "CAST(CAST(f.item_mean_label AS FLOAT) AS DOUBLE) AS score",
        "CAST(CAST('0x' || substr(md5(CAST(s.event_order AS VARCHAR) || '|42'), 1, 8) AS BIGINT) "
        "% 1000003 AS DOUBLE) AS score")
    grnd = with_(BASE, FEATS, rnd, group_sql((k,)))
    q["random_baseline"] = grnd + (
        f"SELECT CAST({me[f'ndcg_at_{k}']} AS FLOAT) AS ndcg_at_{k}, CAST({me[f'map_at_{k}']} AS FLOAT) AS map_at_{k}, "
        f"CAST({GAUC} AS FLOAT) AS gauc, count(*) AS n_groups FROM grp")
    q["load_split"] = ds + (f"SELECT user_id, item_id, event_order, label, {num_sel}, "
                            f"{', '.join(CAT_FEATURES)} FROM dataset WHERE split = 'val'")
    q["dataset_invariants"] = base + (
        "SELECT count(*) AS n_rows, count(*) AS n_dataset_rows, count(DISTINCT event_order) AS n_distinct_events, "
        "CAST(0 AS BIGINT) AS n_bound_violations, CAST(0 AS BIGINT) AS n_null_categorical, "
        "CAST(0 AS BIGINT) AS n_label_mismatch, CAST(0 AS BIGINT) AS n_ratio_out_of_range, "
        "CAST(0 AS BIGINT) AS n_leaky_features FROM inter")
    q["event_order"] = (
        "SELECT event_id AS event_order, user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) "
        "AS item_id, value AS timespent FROM events")
    q["meta_scan"] = base + "SELECT user_id, age, gender, geo FROM users"
    q["npz_embeddings"] = ("SELECT vec_id AS item_id, unnest(range(1, len(embedding) + 1)) AS i, "
                           "unnest(embedding) AS x FROM embeddings")
    q["parquet_embeddings"] = q["npz_embeddings"]
    q["shard_stage_stats"] = q["stage_stats"]
    q["source_catalog"] = """
WITH t0 AS (SELECT min(epoch_us(ts)) AS us FROM events),
wk AS (SELECT DISTINCT CAST(floor((epoch_us(ts) - (SELECT us FROM t0)) / 604800000000) AS INTEGER) AS w
       FROM events),
rk AS (SELECT w, dense_rank() OVER (ORDER BY w DESC) AS back FROM wk),
sh AS (
  SELECT 'interactions' AS category,
         CASE WHEN back = 1 THEN 'test' WHEN back = 2 THEN 'validation' ELSE 'train' END
           || '/week_' || lpad(CAST(w AS VARCHAR), 2, '0') || '.parquet' AS shard,
         w AS week FROM rk
  UNION ALL SELECT 'users', 'metadata/users_metadata.parquet', 1000000000
  UNION ALL SELECT 'items', 'metadata/items_metadata.parquet', 1000000000
  UNION ALL SELECT 'embeddings', 'metadata/item_embeddings', 1000000000)
SELECT category, shard, week,
       CAST(dense_rank() OVER (PARTITION BY category ORDER BY week, shard) AS BIGINT) AS shard_ord
FROM sh"""
    q["manifest_roundtrip"] = q["source_catalog"]
    q["max_shards"] = """
WITH t0 AS (SELECT min(epoch_us(ts)) AS us FROM events),
wk AS (SELECT CAST(floor((epoch_us(ts) - (SELECT us FROM t0)) / 604800000000) AS INTEGER) AS week,
              user_id FROM events)
SELECT week, count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM wk
WHERE week IN (SELECT DISTINCT week FROM wk ORDER BY week LIMIT 2) GROUP BY week"""
    skewed = BASE.replace("p_brand AS author_id", f"CASE WHEN p_partkey % 3 = 0 THEN '{HOT_AUTHOR}' "
                          "WHEN p_partkey % 7 <> 1 THEN p_brand END AS author_id")
    q["assemble_features_skewed"] = q["assemble_features"].replace(BASE.strip(), skewed.strip())
    q["interactions_layout"] = base + (
        "SELECT count(*) AS n_rows, min(event_order) AS first, max(event_order) AS last, "
        "CAST(0 AS BIGINT) AS n_overlaps, CAST(0 AS BIGINT) AS n_unsorted FROM inter")
    q.update(_report_sql(base, feats))
    q.update(_model_sql(base, allm, gby))
    return q


def _report_sql(base: str, feats: str) -> dict[str, str]:
    """Reports of the job's stages: S14 and S15."""
    fixed = [("role", "label", "label", -1), ("role", "group", "user_id", -1), ("role", "item_id", "item_id", -1),
             ("role", "event_order", "event_order", -1)]
    fixed += [("numeric", n, "", k) for k, n in enumerate(NUM_FEATURES)]
    fixed += [("categorical", n, "", k) for k, n in enumerate(CAT_FEATURES)]
    values = ", ".join(f"('{a}', '{b}', '{c}', CAST({v} AS BIGINT))" for a, b, c, v in fixed)
    stats = {"n_rows": "count(*)", "n_users": "count(DISTINCT user_id)", "n_items": "count(DISTINCT item_id)",
             "label_mean": "avg(CAST(label AS DOUBLE))",
             "label_pos_share": "avg(CAST(label >= CAST(1.0 AS FLOAT) AS DOUBLE))",
             "watch_ratio_mean": "avg(CAST(watch_ratio AS DOUBLE))"}
    tracked = " UNION ALL ".join(f"SELECT 'preprocess' AS stage, '{n}' AS name, CAST({e} AS FLOAT) AS value FROM inter"
                                 for n, e in stats.items())
    tables = " ".join(f"UNION ALL SELECT 'features', 'rows_{t}', CAST(count(*) AS FLOAT) FROM {t}_f"
                      for t in ("user", "item", "author", "ua"))
    weeks = ("SELECT count(DISTINCT floor((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) / 604800000000)) "
             "FROM events")
    return {
        "dataset_meta": base + f"""
SELECT * FROM (VALUES {values}) v(kind, name, text, value)
UNION ALL SELECT 'size', split, '', count(*) FROM splitted GROUP BY split
UNION ALL SELECT 'bound', 'train_end', '', train_end FROM bounds
UNION ALL SELECT 'bound', 'val_end', '', val_end FROM bounds""",
        "tracking_scalars": feats + f"""
{tracked}
{tables}
UNION ALL SELECT 'prepare', 'n_shards', CAST(({weeks}) AS FLOAT)
UNION ALL SELECT 'dataset', 'rows_' || split, CAST(count(*) AS FLOAT) FROM splitted GROUP BY split
UNION ALL SELECT 'dataset', 'emb_built', CAST(1 AS FLOAT)""",
    }


def _model_sql(base: str, metrics: dict, by_split: str) -> dict[str, str]:
    """Model queries: what any sound fit must give (counts, ranges, names, order)."""
    model = TD_CFG.model
    names = ", ".join(f"'{n}'" for n in NUM_FEATURES + CAT_FEATURES)
    n_metrics = len(metrics) + 1  # and GAUC
    steps = sorted({*range(model.metric_period, model.max_iter + 1, model.metric_period), model.max_iter})
    return {
        "feature_importance": f"SELECT unnest([{names}]) AS feature, TRUE AS not_negative, TRUE AS adds_to_one",
        "top_importances": "SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS place, TRUE AS holds_the_top",
        "model_roundtrip": base + ("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_changed "
                                   "FROM splitted WHERE split = 'val'"),
        "ranking_fit": base + ("SELECT count(DISTINCT user_id) AS n_groups, CAST(4 AS BIGINT) AS n_trees, "
                               "TRUE AS beats_random_on_train FROM train"),
        "training_curve": f"SELECT CAST(unnest({steps}) AS INTEGER) AS iteration, TRUE AS best_is_argmax, "
                          "TRUE AS ends_at_model",
        "ranker_metrics": by_split + (
            f"SELECT split, count(*) AS n_groups, CAST({n_metrics} AS BIGINT) AS n_metrics, "
            f"CAST({n_metrics} AS BIGINT) AS n_in_range, "
            "TRUE AS beats_random_on_val FROM grp GROUP BY split"),
    }
