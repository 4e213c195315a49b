"""Boosted trees as arrays: scores at any iteration in one Arrow pass.

A fitted tree model is flattened once into node arrays (feature, threshold or
category set, children, value), broadcast, and evaluated per Arrow batch for
all rows of the batch at once. The plan holds one Python stage, however many
trees there are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

X = "_x"
_SPLIT = re.compile(r"If \(feature (\d+) (<=|in|not in) (.+)\)$")


@dataclass(frozen=True)
class FlatTrees:
    """Nodes of all trees in one numbering; a leaf has feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    categories: np.ndarray  # row of ``goes_left`` or -1
    goes_left: np.ndarray  # one row a categorical split: does the category go left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray

    def __len__(self) -> int:
        return len(self.roots)

    def tree(self, i: int, x: np.ndarray) -> np.ndarray:
        """Predictions of one tree for the rows of ``x``."""
        at = np.full(len(x), self.roots[i])
        rows = np.flatnonzero(self.feature[at] >= 0)
        while len(rows):
            node = at[rows]
            v = x[rows, self.feature[node]]
            go = v <= self.threshold[node]
            cat = self.categories[node]
            some = cat >= 0
            if some.any():
                # Categories above all listed ones share the last column: in no set.
                code = np.minimum(v[some].astype(np.int64), self.goes_left.shape[1] - 1)
                go[some] = self.goes_left[cat[some], code]
            at[rows] = node = np.where(go, self.left[node], self.right[node])
            rows = rows[self.feature[node] >= 0]
        return self.value[at]

    def staged(self, x: np.ndarray, stops: list[int]):
        """(iteration, score) at each of the rising ``stops``."""
        total, done = np.zeros(len(x)), 0
        for stop in stops:
            for i in range(done, stop):
                total = total + self.weights[i] * self.tree(i, x)
            done = stop
            yield stop, total


def flatten(texts: list[str], weights) -> FlatTrees:
    """Node arrays from the printed form (``toDebugString``) of single trees, in order."""
    feature, threshold, cats, left, right, value, roots, sets = [], [], [], [], [], [], [], []
    for text in texts:
        waiting: list[int] = []  # splits that still miss a child
        for line in text.splitlines():
            line = line.strip()
            split = _SPLIT.match(line)
            if not split and not line.startswith("Predict:"):
                continue
            n = len(feature)
            if waiting:
                parent = waiting[-1]
                if left[parent] < 0:
                    left[parent] = n
                else:
                    right[parent] = n
                    waiting.pop()
            else:
                roots.append(n)
            feature.append(int(split[1]) if split else -1)
            threshold.append(float(split[3]) if split and split[2] == "<=" else np.nan)
            cats.append(len(sets) if split and split[2] != "<=" else -1)
            if split and split[2] != "<=":
                inside = {int(float(c)) for c in split[3].strip("{}").split(",") if c}
                sets.append((inside, split[2] == "in"))
            value.append(0.0 if split else float(line[len("Predict:"):]))
            left.append(-1)
            right.append(-1)
            if split:
                waiting.append(n)
    width = 1 + max((max(s, default=0) for s, _ in sets), default=0) + 1
    table = np.zeros((max(1, len(sets)), width), bool)
    for k, (inside, member) in enumerate(sets):
        table[k] = not member
        table[k, list(inside)] = member
    as_int = lambda v: np.array(v, np.int64)
    return FlatTrees(as_int(feature), np.array(threshold), as_int(cats), table, as_int(left), as_int(right),
                     np.array(value), as_int(roots), np.array(list(weights), np.float64))


def of_model(gbt) -> FlatTrees:
    """All trees of an MLlib ensemble; its print is one call, however many trees."""
    parts = re.split(r"^\s*Tree \d+ \(weight [^)]*\):\s*$", gbt.toDebugString, flags=re.M)[1:]
    return flatten(parts, gbt.treeWeights)


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of equal-length lists as a matrix."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 1)


def with_array(df: DataFrame, features: str) -> DataFrame:
    """The feature vector as an array column that Arrow hands over."""
    return df.withColumn(X, vector_to_array(F.col(features)))


def staged_scores(df: DataFrame, trees: FlatTrees, keep: list[str], stops: list[int], out: str,
                  iteration: str | None = "iteration") -> DataFrame:
    """``keep`` columns, the iteration and the score after it, one row per row and stop."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(trees)
    schema = T.StructType([df.schema[k] for k in keep])
    if iteration:
        schema = schema.add(iteration, T.IntegerType())
    schema = schema.add(out, T.DoubleType())

    def fn(batches):
        flat = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.ascontiguousarray(matrix(batch.column(batch.num_columns - 1)))
            held = batch.columns[:-1]
            for stop, total in flat.staged(x, stops):
                extra = [pa.array(np.full(len(x), stop, np.int32))] if iteration else []
                yield pa.RecordBatch.from_arrays([*held, *extra, pa.array(total)],
                                                 [*keep, *([iteration] if iteration else []), out])

    return df.select(*keep, X).mapInArrow(fn, schema)
