"""DuckDB SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The plain patterns of the base kinds and of the added ones.
_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]){11,30}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}


def _spans(kind: str) -> str:
    """Matches with code-point offsets: lengths of the pieces before and of the matches."""
    p = _PII[kind]
    return f"""
{kind}_m AS (SELECT id, t, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS g
  FROM d WHERE regexp_matches(t, '{p}')),
{kind}_s AS (SELECT id, t, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'match': m[i],
    'start': CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT)}})) AS s
  FROM {kind}_m),
{kind}_all AS (SELECT id, t, s.match AS m, s.start AS st, s.start + length(s.match) AS en
  FROM {kind}_s)"""


def _alone(chars: str) -> str:
    return (f"NOT regexp_matches(substr(t, CAST(st AS INT), CASE WHEN st > 0 THEN 1 ELSE 0 END), '[{chars}]') "
            f"AND NOT regexp_matches(substr(t, CAST(en AS INT) + 1, 1), '[{chars}]')")


def _near(words: str) -> str:
    return (f"regexp_matches(lower(substr(t, CAST(greatest(st - 47, 1) AS INT), "
            f"CAST(least(st, 48) AS INT))), '{words}')")


def pii_sql() -> str:
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = f"""list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE
      WHEN (length({digits}) - i) % 2 = 0 THEN CAST(substr({digits}, i, 1) AS INT)
      WHEN CAST(substr({digits}, i, 1) AS INT) > 4 THEN 2 * CAST(substr({digits}, i, 1) AS INT) - 9
      ELSE 2 * CAST(substr({digits}, i, 1) AS INT) END)) % 10 = 0"""
    compact = "replace(m, ' ', '')"
    turned = f"(substr({compact}, 5) || substr({compact}, 1, 4))"
    mod97 = f"""list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split({turned}, ''),
      lambda c: CAST(CASE WHEN ascii(c) >= 65 THEN ascii(c) - 55 ELSE ascii(c) - 48 END AS BIGINT))),
      lambda a, x: CASE WHEN x >= 10 THEN (a * 100 + x) % 97 ELSE (a * 10 + x) % 97 END) = 1"""
    valid = {
        "email": "TRUE",
        "ip": "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR "
              "coalesce(TRY_CAST(nullif(ltrim(x, '0'), '') AS INT), 0) > 255)) = 0",
        "card": f"CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN {luhn} ELSE FALSE END",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": f"CASE WHEN length({compact}) BETWEEN 15 AND 34 THEN {mod97} ELSE FALSE END AND "
                + _alone("A-Za-z0-9"),
        "ssn": _alone("0-9-") + " AND " + _near("ssn|social security"),
    }
    every = " UNION ALL ".join(
        f"SELECT id, {i} AS k, '{kind}' AS kind, st, en FROM {kind}_all WHERE {valid[kind]}"
        for i, kind in enumerate(_PII))
    joined = "coalesce(string_agg({}kind || ':' || st || ':' || en, ',' ORDER BY k, st){}, '')"
    base = joined.format("", " FILTER (WHERE k < 4)")
    return f"""
WITH d AS (SELECT doc_id AS id, coalesce(text, '') AS t FROM documents),
{", ".join(_spans(k) for k in _PII)},
every AS ({every}),
per AS (SELECT id, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in list(_PII)[:4])},
  sha256({base}) AS base_sha256, {joined.format("", "")} AS spans FROM every GROUP BY id)
SELECT d.id AS doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in list(_PII)[:4])},
  coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (id)"""


TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(range(1, len(v.e) + 1), lambda i: q.e[i] * v.e[i])) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""

_REACH = """
reach AS (SELECT id, id AS c FROM nodes
  UNION SELECT links.b AS id, reach.c FROM reach JOIN links ON links.a = reach.id),
comp AS (SELECT id, min(c) AS c FROM reach GROUP BY id)"""

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON a.label = b.label AND a.id <> b.id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
nodes AS (SELECT id FROM v),{_REACH},
n AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id,
  vec_id = coalesce(c, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.id = vec_id LEFT JOIN comp ON comp.id = vec_id"""

NEAR_TEXTS = rf"""
WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w),
t AS (SELECT id, len(s) AS n, hash(unnest(s)) AS g FROM s),
links AS (SELECT x.id AS a, y.id AS b FROM t x JOIN t y ON x.g = y.g AND x.id <> y.id
  GROUP BY x.id, y.id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
nodes AS (SELECT id FROM s),{_REACH}
SELECT s.id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id
FROM s JOIN comp ON comp.id = s.id"""

REPEATS = r"""
WITH w AS (SELECT doc_id AS id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)),
low AS (SELECT k, min(id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT id, unnest(range(i, i + 13)) AS i FROM win JOIN low USING (k) WHERE m < id),
words AS (SELECT id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM w),
kept AS (SELECT id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS t
  FROM words ANTI JOIN gone USING (id, i) GROUP BY id)
SELECT w.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (id)"""

# crc32 of UTF-8 text: the table of remainders by its rule, then one step a byte.
_CRC_TABLE = """
crc_bits AS (SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
    FROM crc_bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8)"""


def _crc(text: str) -> str:
    octets = (f"list_transform(range(1, strlen({text}) + 1), lambda i: "
              f"CAST('0x' || substr(hex(encode({text})), CAST(2 * i - 1 AS INT), 2) AS BIGINT))")
    return (f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1]), 4294967295), "
            "4294967295)")


PERIODIC = rf"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id AS id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    {_crc("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc),
a AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (SELECT id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i:
    w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM p),
words AS (SELECT id, n, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i FROM t),
same AS (SELECT x.id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.id = y.id AND x.w = y.w
  AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
isles AS (SELECT id, q, i, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS isle FROM same),
long AS (SELECT id, q, min(i) AS s, count(*) + q AS len FROM isles GROUP BY id, q, isle
  HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT id, s, len, min(q) AS q FROM long GROUP BY id, s, len),
best AS (SELECT id, s, len, q, row_number() OVER (PARTITION BY id ORDER BY
  len // q DESC, CAST(len % q AS DOUBLE) / q DESC, s, q) AS r FROM runs),
all_runs AS (SELECT id, count(*) AS n, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS t
  FROM runs GROUP BY id),
gone AS (SELECT DISTINCT id, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT id, string_agg(w, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (id, i) GROUP BY id)
SELECT t.id AS doc_id, coalesce(all_runs.n, 0) AS n_runs, CAST(s AS BIGINT) AS start, CAST(len AS BIGINT) AS length,
  CAST(q AS BIGINT) AS period, CAST(1000 * len // q AS BIGINT) AS exponent_milli,
  sha256(coalesce(all_runs.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM t LEFT JOIN all_runs ON all_runs.id = t.id LEFT JOIN kept ON kept.id = t.id
  LEFT JOIN best ON best.id = t.id AND best.r = 1"""


def _feature_words(table: str, key: str) -> str:
    return (f"SELECT {key}, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
            rf"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM {table}")


RESAMPLED = rf"""
WITH RECURSIVE {_CRC_TABLE},
f AS ({_feature_words("documents", "doc_id AS id")}),
g AS ({_feature_words("benchmark", "item_id AS id")}),
v AS (SELECT w, {_crc("w")} % 10000 AS b FROM (SELECT w FROM f UNION SELECT w FROM g), crc),
s AS (SELECT b, count(*) AS n FROM f JOIN v USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM g JOIN v USING (w) GROUP BY b),
gain AS (SELECT s.b, floor(1000 * ln((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM f) + 10000)
    / ((s.n + 1) * ((SELECT count(*) FROM g) + 10000)))) AS gain FROM s LEFT JOIN t USING (b)),
x AS (SELECT id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight
  FROM f JOIN v USING (w) JOIN gain USING (b) GROUP BY id),
y AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296))) AS BIGINT) AS score FROM documents LEFT JOIN x ON x.id = doc_id),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM y WHERE n_features >= 20)
SELECT y.doc_id, n_features, weight, score, r.rank FROM y LEFT JOIN r ON r.doc_id = y.doc_id
  AND r.rank <= 10 * (SELECT count(*) FROM r) // 100"""

ORACLE_SQL = {
    "op1_pii": pii_sql(),
    "op6_topk_search": TOP_K,
    "op7_ngram_jaccard_join": NEAR_TEXTS,
    "op9_embedding_near_dedup": NEAR_VECTORS,
    "op11_substring_dedup": REPEATS,
    "op12_periodic_runs": PERIODIC,
    "op13_resampling": RESAMPLED,
}
