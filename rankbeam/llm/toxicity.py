"""Toxicity of texts, read through noisy-channel deobfuscation.

A suspect token (letters mixed with digits or signs, a letter repeated three
times or more, letters set apart by spaces or signs) is taken as the noisy form
of a word. Its characters span a lattice: a letter may be meant or be a
repetition, a digit or sign may stand for letters it resembles, a separator may
be dropped or end a word. A Viterbi search finds the best reading under a
character trigram model that is counted over all documents. The restored words
are then scored: words that occur in toxic rows much more often than in others
have weights, and a logistic model turns a document's weights into a score.

Only the text is an input of a score. Word weights and the logistic model are
learned from a bounded sample of labelled rows (``fit_rows``); the character
model counts every document, and every document is scored.

Defined results: null text is empty text; a text without a weighted word gets
the model's base score, an empty one too; without labels of both classes all
scores are the share of toxic labels (0 when there are none); repeated rows
are scored alike; texts of any length are read whole, in time that grows with
their length (a long token or spaced run is one lattice; what all its open
readings agree on is written out and forgotten); a word with a doubled letter
is read as it stands and as its lattice says; an empty table gives no rows;
other columns pass untouched (columns named like the outputs are replaced).
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, slices, text_buffers

# Letters that a digit or sign is used for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e",
    "£": "l", "¡": "i", "§": "s",
}
#: Characters after which the agreed part of a long token's readings is written out.
SETTLE = 4096
_LETTERS = 28  # boundary, a to z, any other letter
_SPACED = re.compile(r"(?<!\S)\S(?: {1,2}\S){2,}(?!\S)")
# A single sign that stays at the start, and one that goes at the end.
_STAYS_FIRST = frozenset("$@|+€£")
_GOES_LAST = frozenset(".,;:!?\"')]}*#%&>-")
_LONG = re.compile(r"([^\W\d_])\1\1")
_DOUBLED = re.compile(r"([a-z])\1")
# log costs of the channel's arcs
_DROP_REPEAT, _DROP_PAIR, _LOOKALIKE, _DROP_SIGN, _DROP_OTHER, _SPACE = -0.3, -4.0, -0.7, -1.5, -3.0, -1.0
_BREAK_SIGN = _DROP_SIGN + _SPACE / 2  # as much dearer than dropping as at a space
_LETTER_BONUS = 2.2

_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[128:] = 27


def _fold(text: str) -> str:
    """Lower case without marks on letters."""
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower())
                   if not unicodedata.combining(c))


def _sign(c: str) -> bool:
    return not (c.isalnum() or c == "_" or c.isspace())


def _strip_signs(word: str) -> str:
    """``word`` without the signs around it: runs of two or more, and single ones that
    stand for no letter there."""
    lo, hi = 0, len(word)
    while lo < hi and _sign(word[lo]):
        lo += 1
    if lo == 1 and word[0] in _STAYS_FIRST:
        lo = 0
    while hi > lo and _sign(word[hi - 1]):
        hi -= 1
    if len(word) - hi == 1 and word[-1] not in _GOES_LAST:
        hi += 1
    return word[lo:hi]


def _settled(states: dict) -> tuple[list[int], dict]:
    """The classes that the readings of all states begin with, and the states without them."""
    tails = []
    for _, path in states.values():
        nodes = []
        while path:
            nodes.append(path)
            path = path[0]
        tails.append(nodes[::-1])
    same = 0
    for nodes in zip(*tails, strict=False):
        if any(x[1] != nodes[0][1] for x in nodes):
            break
        same += 1
    rest = {}
    for (key, (cost, _)), nodes in zip(states.items(), tails, strict=True):
        path: tuple = ()
        for _, c in nodes[same:]:
            path = (path, c)
        rest[key] = (cost, path)
    return [c for _, c in tails[0][:same]], rest


def trigram_counts(raw: np.ndarray) -> np.ndarray:
    """Counts of (letter before last, last letter, letter) over UTF-8 bytes; a word
    begins after two boundaries and ends with one."""
    c = _CLASS[raw]
    one = np.concatenate([[0], c[:-1]])
    two = np.where(one == 0, 0, np.concatenate([[0, 0], c[:-2]])[:len(c)])
    use = (c > 0) | (one > 0)
    return np.bincount((two * _LETTERS + one)[use] * _LETTERS + c[use], minlength=_LETTERS ** 3)


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log P(letter | two letters before) from all documents, smoothed by bigrams."""
    prepare(docs.sparkSession)

    def run(batches):
        total = np.zeros(_LETTERS ** 3, np.int64)
        for b in slices(batches, text_col, 1 << 20):
            raw, off, _ = text_buffers(b.column(b.schema.get_field_index(text_col)))
            gaps = np.insert(raw, off[1:-1], 32) if len(off) > 2 else raw
            total += trigram_counts(np.append(gaps, 32))
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_pydict({"code": pa.array(at), "cnt": pa.array(total[at])})

    rows = (docs.select(F.col(f"`{text_col}`").alias(text_col)).mapInArrow(run, "code long, cnt long")
            .groupBy("code").agg(F.sum("cnt").alias("cnt")).collect())
    counts = np.zeros(_LETTERS ** 3)
    for r in rows:
        counts[r["code"]] = r["cnt"]
    tri = counts.reshape(_LETTERS, _LETTERS, _LETTERS)
    bi = tri.sum(0) + 0.1
    back = bi / bi.sum(1, keepdims=True)
    strength = 5.0
    return np.log((tri + strength * back[None]) / (tri.sum(2, keepdims=True) + strength))


class Restorer:
    """Restores tokens; remembers what it has restored, up to a bound."""

    KEEP = 300_000

    def __init__(self, logp: np.ndarray):
        self.lm = logp.tolist()
        self.seen: dict[str, tuple[str, ...]] = {}

    def decode(self, token: str) -> str:
        """The best reading of a token's lattice; readings may hold word breaks."""
        lm = self.lm
        long = {m.group(1) for m in _LONG.finditer(token)}
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        run = 0
        before = ""
        done: list[int] = []
        for at, ch in enumerate(token, 1):
            run = run + 1 if ch == before else 1
            before = ch
            arcs: list[tuple[int, float]] = []   # emitted class, cost; -1 drops
            if "a" <= ch <= "z":
                arcs.append((ord(ch) - 96, _LETTER_BONUS))
                if run > 1:
                    arcs.append((-1, _DROP_REPEAT if ch in long or run > 2 else _DROP_PAIR))
            elif ch in LOOKALIKES:
                arcs += [(ord(x) - 96, _LOOKALIKE + _LETTER_BONUS) for x in LOOKALIKES[ch]]
                arcs.append((-1, _DROP_SIGN))
                if not ch.isalnum():
                    arcs.append((0, _BREAK_SIGN))
            elif ch == " ":
                arcs += [(-1, _SPACE / 2), (0, _SPACE)]
            elif ch.isalpha():
                arcs.append((27, _LETTER_BONUS))
            elif ch.isalnum():
                arcs.append((-1, _DROP_OTHER))
            else:
                arcs += [(-1, _DROP_SIGN), (0, _BREAK_SIGN)]
            new: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (x, y), (s, path) in states.items():
                for c, cost in arcs:
                    if c < 0:
                        key, t, p = (x, y), s + cost, path
                    elif c == 0 and y == 0:
                        continue
                    else:
                        key = (0, 0) if c == 0 else (y, c)
                        t, p = s + cost + lm[x][y][c], (path, c)
                    if key not in new or t > new[key][0]:
                        new[key] = (t, p)
            states = new or states
            if at % SETTLE == 0:
                agreed, states = _settled(states)
                done += agreed
        _, (_, path) = max(states.items(), key=lambda kv: (
            kv[1][0] + (lm[kv[0][0]][kv[0][1]][0] if kv[0][1] else 0.0), kv[0]))
        out = []
        while path:
            path, c = path
            out.append(c)
        return "".join(" " if c == 0 else "~" if c == 27 else chr(96 + c) for c in done + out[::-1])

    def _token(self, token: str) -> tuple[str, ...]:
        word = _strip_signs(_fold(token))
        if word.isalpha() and not _LONG.search(word):
            return (word, *self.decode(word).split()) if _DOUBLED.search(word) else (word,)
        if not any(c.isalpha() for c in word):
            return ()
        whole = tuple(self.decode(word).split())
        parts = tuple(p for p in re.split(r"[\W\d_]+", word) if len(p) > 2)
        return whole + parts

    def words(self, text: str | None) -> set[str]:
        """The distinct restored words of a text."""
        if not text:
            return set()
        if len(self.seen) > self.KEEP:
            self.seen.clear()
        out: set[str] = set()
        for token in set(text.split()):
            got = self.seen.get(token)
            if got is None:
                got = self._token(token)
                self.seen[token] = got
            out.update(got)
        for m in _SPACED.finditer(text):
            run = _fold(m.group())
            if sum(c.isalpha() for c in run) >= 2:
                out.update(self.decode(run).split())
        return out


@dataclass(frozen=True)
class ToxicModel:
    logp: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    coef: tuple[float, ...] = (0.0, 0.0, 0.0)
    constant: float | None = None

    def score(self, hits: list[float]) -> float:
        if self.constant is not None:
            return self.constant
        x = _inputs(hits)
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.coef, x), -500, 500))))


def _inputs(hits: list[float]) -> tuple[float, float, float]:
    return (1.0, max(hits, default=0.0), float(np.log1p(sum(hits))))


def _word_weights(n: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Log odds of words that stand in toxic rows more often than chance allows.

    A word's count among toxic rows must be so far above their share that, by the
    Chernoff bound, not one of all tested words would be expected there by chance;
    its weight is the smoothed log odds, less one standard error."""
    out = {}
    share = toxic / (toxic + clean)
    need = np.log(max(2, sum(1 for t, _ in n.values() if t >= 3))) + 2
    for w, (t, c) in n.items():
        if t < 3 or t <= share * (t + c):
            continue
        p = t / (t + c)
        far = t * np.log(p / share) + (c * np.log((1 - p) / (1 - share)) if c else 0.0)
        odds = np.log((t + 0.5) / (toxic - t + 0.5)) - np.log((c + 0.5) / (clean - c + 0.5))
        err = np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5) + 1 / (toxic - t + 0.5) + 1 / (clean - c + 0.5))
        if far > need and odds > err:
            out[w] = float(odds - err)
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w = w - np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, logp: np.ndarray, fit_rows: int = 15_000,
        max_words: int = 20_000) -> ToxicModel:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    ``fit_rows`` bounds the labelled rows (chosen by a hash of the id),
    ``max_words`` the weighted words. Word counts are a Spark aggregation over
    two halves of the sample; the logistic model sees each half through the
    other half's weights.
    """
    spark = prepare(docs.sparkSession)
    labels = (labels.where("toxic is not null and doc_id is not null")
              .select("doc_id", F.col("toxic").cast("int").alias("toxic")))
    total = labels.count()
    if total > fit_rows:
        cut = int((1 << 30) * fit_rows / total)
        labels = labels.where(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) < cut)
    half = F.pmod(F.xxhash64(F.lit(1), F.col("doc_id")), F.lit(2)).cast("int").alias("half")
    rows = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id").select(
        "doc_id", "toxic", half, "text")
    shared = spark.sparkContext.broadcast(logp)

    def count(batches):
        restore = Restorer(shared.value)
        got: Counter = Counter()
        for b in slices(batches, "text"):
            for text, y, h in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(),
                                  b.column("half").to_pylist(), strict=True):
                got[None, h, y] += 1
                for w in restore.words(text):
                    got[w, h, y] += 1
        keys = list(got)
        yield pa.RecordBatch.from_pydict({
            "word": pa.array([k[0] for k in keys], pa.string()),
            "half": pa.array([k[1] for k in keys], pa.int32()),
            "toxic": pa.array([k[2] for k in keys], pa.int32()),
            "cnt": pa.array(list(got.values()), pa.int64())})

    tallies = [F.sum(F.when((F.col("half") == h) & (F.col("toxic") == y), F.col("cnt")).otherwise(0))
               .alias(f"c{h}{y}") for h in (0, 1) for y in (0, 1)]
    counts = (rows.mapInArrow(count, "word string, half int, toxic int, cnt long")
              .groupBy("word").agg(*tallies).where("word is null or c01 + c11 >= 3")
              .orderBy(F.col("word").isNotNull(), F.desc(F.col("c01") + F.col("c11") -
                       F.least(F.col("c00") + F.col("c10"), F.lit(1 << 40)) * 0.1), "word")
              .limit(1 + 4 * max_words).collect())
    sums = next((r for r in counts if r["word"] is None), None)
    toxic = sums["c01"] + sums["c11"] if sums else 0
    clean = sums["c00"] + sums["c10"] if sums else 0
    if not toxic or not clean:
        return ToxicModel(logp, constant=1.0 if toxic else 0.0)
    named = [r for r in counts if r["word"] is not None]
    whole = _word_weights({r["word"]: (r["c01"] + r["c11"], r["c00"] + r["c10"]) for r in named},
                          toxic, clean)
    whole = dict(sorted(whole.items(), key=lambda kv: (-kv[1], kv[0]))[:max_words])
    by_half = [_word_weights({r["word"]: (r[f"c{h}1"], r[f"c{h}0"]) for r in named},
                             sums[f"c{h}1"], sums[f"c{h}0"]) for h in (0, 1)]
    wanted = spark.sparkContext.broadcast(set(whole).union(*by_half))

    def meet(batches):
        restore = Restorer(shared.value)
        for b in slices(batches, "text"):
            hits = [sorted(restore.words(t) & wanted.value) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"toxic": b.column("toxic"), "half": b.column("half"),
                                              "hits": pa.array(hits, pa.list_(pa.string()))})

    seen = rows.mapInArrow(meet, "toxic int, half int, hits array<string>").collect()
    x = np.array([_inputs([by_half[1 - r["half"]][w] for w in r["hits"] if w in by_half[1 - r["half"]]])
                  for r in seen])
    y = np.array([r["toxic"] for r in seen], float)
    return ToxicModel(logp, whole, tuple(_logistic(x, y).tolist()))


def score(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``found``
    (the weighted words that were read)."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    docs = docs.drop("score", "predicted", "found")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()),
                           T.StructField("found", T.ArrayType(T.StringType()))])

    def run(batches):
        m = shared.value
        restore = Restorer(m.logp)
        for b in slices(batches, text_col):
            found = [sorted(w for w in restore.words(t) if w in m.weights)
                     for t in b.column(text_col).to_pylist()]
            s = np.array([m.score([m.weights[w] for w in f]) for f in found])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32)),
                 pa.array(found, pa.list_(pa.string()))],
                names=[*b.schema.names, "score", "predicted", "found"])

    return docs.mapInArrow(run, schema)
