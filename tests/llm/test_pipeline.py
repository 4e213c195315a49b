"""The pipeline and the registered queries."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from rankbeam.llm import langid, mixing, pii
from rankbeam.llm.queries import ORACLE_SQL, QUERIES, tokenizer_file
from tests_llm_plain import plain_components, plain_spans

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    names = sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert set(ORACLE_SQL) <= set(QUERIES) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "ngram_jaccard_join", "pii", "mixing", "bpe"]


def _redacted(text):
    """Plain redaction: spans by start, overlapping ones merge into the first."""
    spans = []
    for s in plain_spans(text):
        k, a, b = s.split(":")
        spans.append((int(a), int(b), k))
    out, at = [], 0
    for a, b, k in sorted(spans):
        if a >= at:
            out.append(text[at:a] + f"[{k.upper()}]")
        at = max(at, b)
    return "".join(out) + text[at:]


def _plain_mix(rows, budget):
    """Inclusion probabilities by plain raking over a dict of cells."""
    cells = defaultdict(float)
    for r in rows:
        cells[r["source"], r["lang"], r["topic"]] += r["tokens"]
    goals = []
    for d, name in enumerate(("source", "lang", "topic")):
        have = defaultdict(float)
        for k, t in cells.items():
            have[k[d]] += t
        goal = {v: t ** mixing.EXPONENTS[name] for v, t in have.items()}
        goals.append({v: g / sum(goal.values()) for v, g in goal.items()})
    w = dict(cells)
    for _ in range(30):
        worst = 0.0
        for d, goal in enumerate(goals):
            s = defaultdict(float)
            for k, x in w.items():
                s[k[d]] += x
            worst = max(worst, sum(abs(s[v] - g) for v, g in goal.items()))
            w = {k: x * goal[k[d]] / s[k[d]] for k, x in w.items()}
        if worst < 1e-4:
            break
    want = budget * sum(cells.values())
    lo, hi = 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        got = sum(t * min(1.0, mid * w[k] / t) for k, t in cells.items())
        lo, hi = (mid, hi) if got < want else (lo, mid)
    return {k: min(1.0, lo * w[k] / t) for k, t in cells.items()}


def test_pipeline_equals_plain_stages(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where("crc32(cast(doc_id as string)) % 3 <> 1"))
    rows = [r.asDict() for r in docs.collect()]
    scorer = langid._Scorer(model)
    rows = [r for r in rows if scorer(r["text"])[0] != "und" and scorer(r["text"])[1] >= 0.3]
    comp = {d: c for d, _, c in plain_components([(r["doc_id"], r["text"]) for r in rows])}
    rows = [r for r in rows if comp[r["doc_id"]] == r["doc_id"]]
    for r in rows:
        r["text"] = _redacted(r["text"] or "")
        r["topic"] = ("table" if " | " in r["text"] else
                      "notice" if re.search("licen[sc]e|copyright|all rights reserved", r["text"].lower()) else
                      "keyed" if re.search(r"[=:] ?[\"']?[0-9a-f]{12,}|https?://", r["text"]) else "prose")
        r["tokens"] = r["text"].count(" ") + r["text"].count("\n") + 1 if r["text"] else 0
    prob = _plain_mix(rows, 0.5)
    draw = {r["doc_id"]: r["u"] for r in docs.select("doc_id", (F.pmod(
        F.xxhash64(F.lit(7), F.col("doc_id")), F.lit(1 << 40)) / F.lit(float(1 << 40))).alias("u")).collect()}
    lib = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    want = {r["doc_id"]: (r["lang"], r["source"], lib.encode(r["text"], add_special_tokens=False).ids)
            for r in rows if draw[r["doc_id"]] < prob[r["source"], r["lang"], r["topic"]]}
    out = corpus_pipeline.run(spark, SF)
    got = {r["doc_id"]: (r["lang"], r["source"], list(r["ids"])) for r in out.collect()}
    assert got == want and out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b c d e f a@b.cd", "en", "s", 18),
         (3, "a b c d e f a@b.cd", "en", "s", 18), (None, "the and of to", "en", None, 13)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for d in (odd, odd.limit(0)):
            out = stage(spark, d, SF)
            assert out.columns == odd.columns, name
            assert out.count() <= d.count()
    assert corpus_pipeline.STAGES[-1][1](spark, odd, SF).count() == odd.count()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op7_ngram_jaccard_join", "op9_embedding_near_dedup"}))
def test_query_columns(spark, name):
    need = {
        "op1": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op2": "doc_id held_out score predicted",
        "op3": "doc_id held_out lang_pred score", "op4": "doc_id start n_tokens ids_crc32",
        "op5": "doc_id held_out score predicted", "op6": "query_id rank vec_id score",
        "op8": "doc_id n_tokens ids_sha256 decoded_sha256", "op10": "doc_id source lang weight prob kept",
        "op11": "doc_id n_words n_removed kept_sha256",
        "op12": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
        "op13": "doc_id n_features weight score rank",
    }[name.split("_")[0]]
    df = QUERIES[name](spark, SF)
    assert set(need.split()) <= set(df.columns)
    if name != "op6_topk_search":
        assert df.count() == 200
    assert np.isfinite(df.count())


def test_pii_of_pipeline_leaves_no_base_span(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = pii.redact(docs)
    assert pii.find(out).where("size(spans) > 0").count() == 0
    assert out.where("n_chars <> length(text)").count() == 0


def test_stages_keep_columns_of_any_name(spark):
    """Columns called like what the stages add: values, types and order stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).withColumns({
        "score": F.concat(F.lit("s"), "doc_id"), "tokens": F.array("doc_id"), "kept": F.lit("yes"),
        "weight": F.col("doc_id") * 2, "spans": F.struct("doc_id"), "Lang_Pred": F.lit(None).cast("date"),
        "__h": F.lit("hash"), "__t": F.col("doc_id") % 3, "held_7": F.lit(1.5), "prob": F.lit(True)})
    extra = [c for c in docs.columns if c not in ("text", "n_chars")]
    before = {r["doc_id"]: tuple(r[c] for c in extra) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes], name
        rows = out.collect()
        assert rows and all(before[r["doc_id"]] == tuple(r[c] for c in extra) for r in rows), name
