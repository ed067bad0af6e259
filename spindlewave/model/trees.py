"""Ensembles of softmax trees: numpy walks, column expressions, and their table."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_MARGIN = 0.5
# Ensembles with more leaves are walked over constant arrays, not written out as conditions,
# which would outgrow the methods that Spark compiles.
NESTED_LEAVES = 128


@dataclass
class Tree:
    """Nodes by number, the root first. A leaf has feature -1; a value goes left up to the border, inclusive."""

    feature: np.ndarray
    border: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of x; NaN goes the way learned for missing values."""
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        going = self.feature[node] >= 0
        while going.any():
            at, own = rows[going], node[going]
            v = x[at, self.feature[own]]
            left = np.where(np.isnan(v), self.missing_left[own], v <= self.border[own])
            node[going] = np.where(left, self.left[own], self.right[own])
            going = self.feature[node] >= 0
        return node

    def depth(self) -> int:
        level, found = [0], 0
        while True:
            level = [c for n in level if self.feature[n] >= 0 for c in (int(self.left[n]), int(self.right[n]))]
            if not level:
                return found
            found += 1

    def nested(self, names: Sequence[str], node: int = 0) -> str:
        """The tree as one SQL condition within another; ``names`` are columns without NaN."""
        if self.feature[node] < 0:
            return f"{float(self.value[node])!r}D"
        test = f"{names[self.feature[node]]} <= {float(self.border[node])!r}D"
        if self.missing_left[node]:
            test = f"coalesce({test}, true)"
        left, right = (self.nested(names, int(side[node])) for side in (self.left, self.right))
        return f"CASE WHEN {test} THEN {left} ELSE {right} END"


def walked(trees: Sequence[Tree], names: Sequence[str]) -> str:
    """The sum of trees as SQL that walks over constant arrays, whatever their size."""
    kinds = {"f": ("feature", "int"), "b": ("border", "double"), "m": ("missing_left", "boolean"),
             "l": ("left", "int"), "r": ("right", "int"), "v": ("value", "double")}
    rows = [{key: getattr(tree, name).tolist() for key, (name, _) in kinds.items()} for tree in trees]
    struct = ",".join(f"{key}:array<{kind}>" for key, (_, kind) in kinds.items())
    constant = f"from_json('{json.dumps(rows)}', 'array<struct<{struct}>>')"
    test = f"coalesce(array({', '.join(names)})[t.f[n]] <= t.b[n], t.m[n])"
    step = f"CASE WHEN t.f[n] < 0 THEN n WHEN {test} THEN t.l[n] ELSE t.r[n] END"
    deepest = max([1, *(tree.depth() for tree in trees)])
    leaf = f"aggregate(sequence(1, {deepest}), 0, (n, i) -> {step})"
    return f"aggregate({constant}, {BASE_MARGIN}D, (s, t) -> s + t.v[{leaf}])"


TREE_SCHEMA = T.StructType([
    T.StructField("round", T.IntegerType()), T.StructField("class", T.IntegerType()),
    T.StructField("feature", T.ArrayType(T.IntegerType())), T.StructField("border", T.ArrayType(T.DoubleType())),
    T.StructField("missing_left", T.ArrayType(T.BooleanType())), T.StructField("left", T.ArrayType(T.IntegerType())),
    T.StructField("right", T.ArrayType(T.IntegerType())), T.StructField("value", T.ArrayType(T.DoubleType())),
    T.StructField("columns", T.ArrayType(T.StringType())), T.StructField("missing", T.DoubleType()),
])


@dataclass
class SoftmaxTrees:
    """One tree per round and class; the class with the largest margin is predicted, the first of equal ones.

    Null and NaN are missing, and so is the number ``missing`` if given.
    """

    rounds: list[list[Tree]]
    columns: list[str]
    classes: int
    missing: float | None = None

    def values(self, batch: pa.RecordBatch | pa.Table) -> np.ndarray:
        """The feature columns of a batch [rows, features], missing values as NaN."""
        found = [np.asarray(batch.column(name).cast(pa.float64()).fill_null(np.nan)) for name in self.columns]
        return self.cleaned(np.stack(found, axis=1) if found else np.zeros((len(batch), 0)))

    def cleaned(self, x: np.ndarray) -> np.ndarray:
        return x if self.missing is None else np.where(x == self.missing, np.nan, x)

    def steps(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The margins [rows, classes] after every round."""
        margin = np.full((len(x), self.classes), BASE_MARGIN)
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                margin[:, k] += tree.value[tree.leaves(x)]
            yield margin

    def margins(self, x: np.ndarray) -> np.ndarray:
        margin = np.full((len(x), self.classes), BASE_MARGIN)
        for margin in self.steps(x):
            pass
        return margin

    def margin_columns(self, nested_leaves: int = NESTED_LEAVES) -> tuple[dict[str, Column], dict[str, Column]]:
        """Columns of cleaned features, and the margins of the classes as expressions over them."""
        own = {}
        for k, name in enumerate(self.columns):
            value = F.col(f"`{name}`").cast("double")
            odd = F.isnan(value) if self.missing is None else F.isnan(value) | (value == F.lit(float(self.missing)))
            own[f"__x{k}"] = F.when(~odd, value)
        leaves = sum(int((tree.feature < 0).sum()) for trees in self.rounds for tree in trees)
        sums = {}
        for k in range(self.classes):
            every = [trees[k] for trees in self.rounds]
            if leaves <= nested_leaves:
                text = " + ".join([f"{BASE_MARGIN}D", *(tree.nested(list(own)) for tree in every)])
            else:
                text = walked(every, list(own))
            sums[f"__m{k}"] = F.expr(text)
        return own, sums

    def transform(self, rows: DataFrame, nested_leaves: int = NESTED_LEAVES) -> DataFrame:
        """``rows`` with ``prediction``, by expressions alone, on a table or a stream."""
        own, sums = self.margin_columns(nested_leaves)
        most = F.greatest(*sums) if len(sums) > 1 else F.col("__m0")
        best = F.lit(None).cast("double")
        for k in reversed(range(self.classes)):
            best = F.when(F.col(f"__m{k}") == most, float(k)).otherwise(best)
        kept = [F.col(f"`{name}`") for name in rows.columns if name != "prediction"]
        return rows.select(*kept, *[c.alias(n) for n, c in own.items()]).select(
            *kept, *[c.alias(n) for n, c in sums.items()]
        ).select(*kept, best.alias("prediction"))

    def transform_batches(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prediction``, by numpy walks over Arrow batches."""
        kept = rows.drop("prediction")
        schema = T.StructType([*kept.schema.fields, T.StructField("prediction", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = self.margins(self.values(batch)).argmax(axis=1).astype(float)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], schema.fieldNames())

        return kept.mapInArrow(run, schema)

    def table(self, spark: SparkSession) -> DataFrame:
        names = [f.name for f in fields(Tree)]
        rows = [
            (r, k, *[getattr(tree, name).tolist() for name in names], self.columns, self.missing)
            for r, trees in enumerate(self.rounds)
            for k, tree in enumerate(trees)
        ]
        return spark.createDataFrame(rows, TREE_SCHEMA)

    def save(self, path: str) -> None:
        self.table(SparkSession.active()).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, path: str) -> SoftmaxTrees:
        # The rows are the model itself: one per round and class.
        rows = SparkSession.active().read.schema(TREE_SCHEMA).parquet(f"{path}/trees").orderBy("round", "class").collect()
        kinds = {"feature": int, "border": float, "missing_left": bool, "left": int, "right": int, "value": float}
        rounds: list[list[Tree]] = []
        for row in rows:
            if row["class"] == 0:
                rounds.append([])
            rounds[-1].append(Tree(**{name: np.array(row[name], kind) for name, kind in kinds.items()}))
        return cls(rounds, list(rows[0]["columns"]), len(rounds[0]), rows[0]["missing"])
