"""Quality scores by Bradley-Terry pairwise ranking.

A document's worth is linear in features of its text (shares of character
classes, word and line repetition, lengths). The weights are learned from
preference pairs, a document labelled 1 over one labelled 0, by logistic loss
on the difference of their features. A quantile of the worths of the labelled
sample is the threshold: the one that agrees best with the labels. Scores are
0.7 at the threshold and rise with the worth.

Only the text is an input of a score. The fit uses a bounded sample of labelled
rows (``fit_rows``) and of pairs among them (``fit_pairs``); every document is
scored.

Defined results: null text is empty text and is scored as such; without a
preference pair (no labels, or one class only) every score is 1 if the class
is 1 or missing, else 0; rows without a label or text id take no part in the
fit; repeated labels count as often as they stand; ties in worth get equal
scores; an empty table gives no rows; other columns pass untouched (columns
named like the outputs are replaced).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, slices

KEEP_AT = 0.7
_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58),
    "space": (9, 10, 11, 12, 13, 32), "stop": tuple(b".,;:?'\"()-"), "bang": (33,), "bar": (124,),
    "symbol": tuple(b"#$%&*+/<=>@[\\]^_`{}~"), "wide": range(128, 256),
}
_MASK = np.zeros((256, len(_CLASSES)))
for _i, _c in enumerate(_CLASSES.values()):
    _MASK[list(_c), _i] = 1.0
N_FEATURES = 2 * (len(_CLASSES) + 8)


def features(text: str | None) -> np.ndarray:
    """Feature vector of one whole text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    hist = np.bincount(raw, minlength=256).astype(float)
    n = max(1, len(raw))
    shares = hist @ _MASK / n
    words = text.split()
    counts = Counter(words)
    nw = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    letters = shares[0] + shares[1] + 1e-9
    more = [np.log1p(len(raw)) / 10, len(counts) / nw, pairs / max(1, nw - 1),
            max(counts.values(), default=0) / nw, min(20.0, len(raw) / nw) / 10,
            1 - len(set(lines)) / max(1, len(lines)), shares[0] / letters,
            sum(not w[-1].isalnum() and w[-1] not in ".,;:?!" for w in counts) / max(1, len(counts))]
    x = np.concatenate([shares, more])
    return np.concatenate([x, np.sqrt(np.maximum(x, 0))])


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    constant: float | None = None

    def worth(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        at = np.log(KEEP_AT / (1 - KEEP_AT)) + self.worth(x) - self.threshold
        out = 1 / (1 + np.exp(-np.clip(at, -500, 500)))
        return np.where(self.worth(x) >= self.threshold, np.maximum(out, KEEP_AT), out)


def _with_features(docs: DataFrame) -> DataFrame:
    schema = T.StructType([*docs.schema.fields,
                           T.StructField("features", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for b in slices(batches, "text"):
            x = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([v.tolist() for v in x], pa.list_(pa.float64()))],
                names=[*b.schema.names, "features"])

    return docs.mapInArrow(run, schema)


def fit_pairs(x: np.ndarray, y: np.ndarray, n_pairs: int, seed: int = 0,
              ridge: float = 1e-3, rounds: int = 60) -> QualityModel:
    """Bradley-Terry weights from pairs (label 1 over label 0) by damped Newton steps."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    nothing = np.zeros(N_FEATURES)
    if not len(good) or not len(bad):
        return QualityModel(nothing, nothing + 1, nothing, 0.0, 0.0 if len(bad) else 1.0)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, n_pairs)] - z[rng.choice(bad, n_pairs)]
    w = np.zeros(z.shape[1])
    eye = np.eye(len(w))

    def loss(v):
        return np.logaddexp(0, -(d @ v)).mean() + ridge * v @ v / 2

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        grad = -(d * p[:, None]).mean(0) + ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * eye
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and (new := loss(w - size * step)) > now:
            size /= 2
        if size <= 1e-6 or now - new < 1e-9:
            break
        w, now = w - size * step, new
    worth = z @ w
    # the quantile of the sample's worths whose cut agrees with most labels
    cuts = np.unique(np.quantile(worth, np.linspace(0, 1, 401)))
    agree = [np.mean((worth >= c) == (y == 1)) for c in cuts]
    best = int(np.argmax(agree))
    below = worth[worth < cuts[best]]
    middle = (cuts[best] + below.max()) / 2 if len(below) else cuts[best] - 1e-9
    return QualityModel(mean, scale, w, float(middle))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 12_000,
        n_pairs: int = 60_000) -> QualityModel:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality). ``fit_rows``
    bounds the labelled rows that are used (chosen by a hash of the id); their
    features, a bounded matrix, come to the driver."""
    prepare(docs.sparkSession)
    labels = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality")
    total = labels.count()
    if total > fit_rows:
        cut = int((1 << 30) * fit_rows / total)
        labels = labels.where(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) < cut)
    rows = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")
    got = _with_features(rows.select("doc_id", "quality", "text")).drop("text")
    got = got.orderBy("doc_id", "quality").collect()
    x = np.array([r["features"] for r in got]).reshape(len(got), N_FEATURES)
    y = np.array([r["quality"] for r in got], np.int64)
    return fit_pairs(x, y, n_pairs)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on)."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for b in slices(batches, "text"):
            x = np.array([features(t) for t in b.column("text").to_pylist()])
            s = shared.value.score(x.reshape(b.num_rows, N_FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s), pa.array((s >= KEEP_AT).astype(np.int32))],
                names=[*b.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, schema)
