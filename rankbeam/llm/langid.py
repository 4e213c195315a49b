"""Language identification by word-first backoff.

A word that the model knows is scored by its log frequency in each language.
An unseen word falls back to its character 5-grams, and where none of them is
known to 4-grams, and so on down to single characters; a word with no known
character says nothing. A document's score adds up its words.

Defined results: null text, empty text and text without a letter give ``und``
with score 0; a tie goes to the language that sorts first; repeated rows are
scored alike; an empty training set makes every text ``und``; an empty table
gives no rows. Texts of any length are read whole; a null id changes nothing but
that the row is in no sample of a large language. ``predict`` replaces columns
called ``lang_pred`` and ``score``; ``drop_unidentified`` leaves all columns as
they are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, shield, slices

ORDERS = (5, 4, 3, 2, 1)
UND = "und"
#: Bytes of text that a worker turns into strings at once.
SLICE = 1 << 20
_WORD = regex.compile(r"\p{L}+")


@dataclass(frozen=True)
class LangModel:
    """``rows``: one vector of per-language log shares for each known string."""

    langs: tuple[str, ...]
    words: dict[str, int]
    grams: dict[str, int]
    rows: np.ndarray


def _grams(word: str, n: int) -> list[str]:
    padded = f"<{word}>"
    if n == 1:
        return list(word)
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (lang, n, item, cnt); n is 0 for words. Grams are cut from
    distinct words, weighted by the word's count."""
    words: dict[str, Counter] = {}

    def rows(lang, n, counts):
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(counts), pa.string()), pa.array(np.full(len(counts), n, np.int32)),
             pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["lang", "n", "item", "cnt"])

    def flush():  # one language and order at a time: a fraction of all grams is held
        for lang, seen in words.items():
            yield rows(lang, 0, seen)
            for n in ORDERS:
                counts: Counter = Counter()
                for word, c in seen.items():
                    for g in _grams(word, n):
                        counts[g] += c
                yield rows(lang, n, counts)
        words.clear()

    for batch in slices(batches, "text", SLICE):
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(),
                              strict=True):
            words.setdefault(lang, Counter()).update(_WORD.findall(text.lower()))
        if sum(map(len, words.values())) > 50_000:
            yield from flush()
    yield from flush()


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        fit_rows: int = 8_000, max_words: int = 60_000, max_grams: int = 25_000) -> LangModel:
    """Learn from labelled rows.

    ``fit_rows`` bounds the sample of labelled rows of each language (chosen by a
    hash of the id, so it is the same sample on each run; a smaller language is
    read whole); ``max_words`` and ``max_grams`` (per order) bound the model's
    size, first what has the largest share of its language. Counting is a Spark
    aggregation; only the bounded model comes to the driver.
    """
    prepare(train.sparkSession)
    rows = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                       F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)).alias("place"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size"))
    rows = rows.join(F.broadcast(sizes), "lang").where(
        (F.col("size") <= fit_rows) | (F.col("place") < (1 << 30) * fit_rows / F.col("size")))
    counts = (rows.select("lang", "text")
              .mapInArrow(_count, "lang string, n int, item string, cnt long")
              .groupBy("n", "item", "lang").agg(F.sum("cnt").alias("cnt")))
    items = (counts.groupBy("n", "item")
             .agg(F.collect_list(F.struct("lang", "cnt")).alias("by")).cache())
    try:
        # counts of all items by order and language: a few numbers on the driver
        totals = {(r["n"], r["lang"]): r["total"] for r in items.select("n", F.inline("by"))
                  .groupBy("n", "lang").agg(F.sum("cnt").alias("total")).collect()}
        langs = tuple(sorted({lang for _, lang in totals}))

        def share(n):
            of = {lang: t for (m, lang), t in totals.items() if m == n}
            if not of:
                return F.lit(0.0)
            size = F.create_map(*[F.lit(x) for pair in of.items() for x in pair])
            return F.array_max(F.transform("by", lambda x: x["cnt"] / F.element_at(size, x["lang"])))

        parts = [items.where(F.col("n") == n)
                 .orderBy(F.desc(share(n)), "item").limit(max_grams if n else max_words).toArrow()
                 for n in (0, *ORDERS)]
    finally:
        items.unpersist()
    at = {lang: i for i, lang in enumerate(langs)}
    words: dict[str, int] = {}
    grams: dict[str, int] = {}
    blocks = []
    base = 0
    for n, part in zip((0, *ORDERS), parts, strict=True):
        size = part.num_rows
        m = np.zeros((size, len(langs)))
        (words if n == 0 else grams).update(
            zip(part.column("item").to_pylist(), range(base, base + size), strict=True))
        base += size
        if size:
            by = part.column("by").combine_chunks()
            row = np.repeat(np.arange(size), by.value_lengths().to_numpy(False))
            flat = by.flatten()
            m[row, [at[x] for x in flat.field("lang").to_pylist()]] = flat.field("cnt").to_numpy(False)
        # log frequency in each language, add-half smoothed, then the share of each language
        logp = np.log(m + 0.5) - np.log(m.sum(0) + 0.5 * max(1, size))
        top = logp.max(1, keepdims=True) if len(langs) else logp
        blocks.append(logp - (top + np.log(np.exp(logp - top).sum(1, keepdims=True)))
                      if len(langs) else logp)
    return LangModel(langs, words, grams, np.concatenate(blocks) if blocks else np.zeros((0, 0)))


class _Scorer:
    """Scores texts; remembers the vectors of unseen words up to a bound."""

    KEEP = 150_000

    def __init__(self, model: LangModel):
        self.m = model
        self.base = len(model.rows)
        self.rows = np.vstack([model.rows, np.zeros((self.KEEP, max(1, len(model.langs))))]) \
            if len(model.langs) else model.rows
        self.seen: dict[str, int] = {}

    def _unseen(self, word: str) -> int:
        for n in ORDERS:
            hit = [self.m.grams[g] for g in _grams(word, n) if g in self.m.grams]
            if hit:
                v = self.m.rows[hit].mean(0)
                break
        else:
            v = np.zeros(len(self.m.langs))
        at = self.base + len(self.seen)
        self.rows[at] = v
        self.seen[word] = at
        return at

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = _WORD.findall(text.lower()) if text else []
        if not words or not self.m.langs:
            return UND, 0.0
        total = np.zeros(len(self.m.langs))
        known, seen = self.m.words, self.seen
        for lo in range(0, len(words), 20_000):
            part = words[lo:lo + 20_000]
            if len(seen) + len(part) > self.KEEP:
                seen.clear()
            idx = []
            for w in part:
                i = known.get(w)
                if i is None:
                    i = seen.get(w)
                    if i is None:
                        i = self._unseen(w)
                idx.append(i)
            total += self.rows[idx].sum(0)
        best = int(np.argmax(total))
        tempered = total / np.sqrt(len(words))
        e = np.exp(tempered - tempered.max())
        return self.m.langs[best], float(e[best] / e.sum())


def predict(docs: DataFrame, model: LangModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added (same-named columns are replaced)."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches):
        score = _Scorer(shared.value)
        for b in slices(batches, text_col, SLICE):
            got = [score(t) for t in b.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())],
                names=[*b.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, scored: DataFrame, min_score: float = 0.3) -> DataFrame:
    """Rows of ``scored`` whose language was identified, with the columns of ``docs``.

    Rejected: ``und`` (no letter in it) and a winning language below ``min_score``.
    """
    return (scored.where((F.col("lang_pred") != UND) & (F.col("score") >= min_score))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def drop_unidentified(docs: DataFrame, model: LangModel, min_score: float = 0.3) -> DataFrame:
    """``docs`` without the rows that ``keep_identified`` rejects; all columns, also those called
    ``lang_pred`` or ``score``, stay as they are."""
    hidden, restore = shield(docs, ("lang_pred", "score"))
    return restore(keep_identified(hidden, predict(hidden, model), min_score))


def brute_force(model: LangModel, texts: list[str | None]) -> pd.DataFrame:
    """Plain per-word sums, for tests."""
    out = []
    for t in texts:
        words = _WORD.findall((t or "").lower())
        total = np.zeros(len(model.langs))
        for w in words:
            if w in model.words:
                total += model.rows[model.words[w]]
                continue
            for n in ORDERS:
                hit = [g for g in _grams(w, n) if g in model.grams]
                if hit:
                    total += sum(model.rows[model.grams[g]] for g in hit) / len(hit)
                    break
        out.append(model.langs[int(np.argmax(total))] if words and model.langs else UND)
    return pd.DataFrame({"lang_pred": out})
