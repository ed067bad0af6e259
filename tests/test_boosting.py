from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spindlewave.model import boosting, train
from spindlewave.model.boosting import Softmax
from spindlewave.model.trees import BASE_MARGIN, SoftmaxTrees, Tree

COLUMNS = ("a", "b c", "d")


def examples(n=300, seed=0, missing=True):
    random = np.random.default_rng(seed)
    x = np.round(random.normal(size=(n, 3)), 1)
    label = (x[:, 0] > 0.3).astype(int) + (x[:, 1] * x[:, 0] > 0.4).astype(int)
    if missing:
        # Values are missing where the label is 2, so that the direction tells something.
        x[(random.random(n) < 0.5) & (label == 2), 2] = np.nan
        x[random.random(n) < 0.1, 1] = np.nan
    return x, label


def frame(spark, x, label, odd=False):
    rows = [(k, *[None if math.isnan(v) and not (odd and k % 2) else float(v) for v in r], int(y)) for k, (r, y) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "k int, a double, `b c` double, d double, label int").repartition(3)


def brute_tree(spec, x, g, h, candidates, depth):
    """Exact greedy tree, row by row, as nested tuples; a leaf is its value."""
    leaf = -spec.learning_rate * g.sum() / (h.sum() + spec.ridge)
    if depth == 0 or h.sum() < 2 * spec.min_child:
        return leaf
    whole, best = g.sum() ** 2 / (h.sum() + spec.ridge), None
    for f in range(x.shape[1]):
        for border in candidates[f]:
            for to_left in (True, False):
                left = np.array([to_left if math.isnan(v) else v <= border for v in x[:, f]])
                gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
                if hl < spec.min_child or hr < spec.min_child:
                    continue
                gain = gl**2 / (hl + spec.ridge) + gr**2 / (hr + spec.ridge) - whole
                if gain > 1e-6 and gain >= spec.split_penalty and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, border, to_left, left)
    if best is None:
        return leaf
    _, f, border, to_left, left = best
    sides = [brute_tree(spec, x[m], g[m], h[m], candidates, depth - 1) for m in (left, ~left)]
    return (f, border, to_left, *sides)


def brute_value(tree, row):
    while isinstance(tree, tuple):
        f, border, to_left, left, right = tree
        goes = to_left if math.isnan(row[f]) else row[f] <= border
        tree = left if goes else right
    return tree


def brute_margins(spec, x, label, candidates):
    margin = np.full((len(x), spec.classes), BASE_MARGIN)
    steps = []
    for _ in range(spec.rounds):
        e = np.exp(margin)
        p = e / e.sum(axis=1, keepdims=True)
        added = np.zeros_like(margin)
        for k in range(spec.classes):
            g, h = p[:, k] - (label == k), 2 * p[:, k] * (1 - p[:, k])
            tree = brute_tree(spec, x, g, h, candidates, spec.max_depth)
            added[:, k] = [brute_value(tree, row) for row in x]
        margin = margin + added
        steps.append(margin)
    return steps


def table_of(x):
    return pa.table({name: pa.array(x[:, k]) for k, name in enumerate(COLUMNS)})


@pytest.mark.parametrize("local_rows", [100_000, 40, 0])
def test_trees_by_brute_force(spark, local_rows):
    """Whole trees in one task, upper levels as jobs, and every level as jobs give the exact trees."""
    x, label = examples()
    spec = Softmax(
        rounds=3, max_depth=4, learning_rate=0.3, subsample=1, column_sample=1, min_child=2, split_penalty=0.05, ridge=1,
        classes=3, bins=200, local_rows=local_rows, columns=COLUMNS,
    )
    df = frame(spark, x, label, odd=True)
    model = spec.fit(df)
    candidates = boosting._Run(spec, df).borders
    assert all(len(c) > 20 and set(c) <= set(column) for c, column in zip(candidates, x.T, strict=True))
    expected = brute_margins(spec, x, label, candidates)
    for found, wanted in zip(model.steps(model.values(table_of(x))), expected, strict=True):
        assert np.allclose(found, wanted, atol=1e-9)
    assert (expected[-1].argmax(axis=1) == label).mean() > 0.9
    assert any(t.missing_left.any() for r in model.rounds for t in r) and max(t.depth() for r in model.rounds for t in r) > 1


def test_expressions_walks_and_stored_trees_agree(spark, tmp_path):
    x, label = examples(400, 3)
    spec = Softmax(rounds=4, max_depth=6, learning_rate=0.3, classes=3, columns=COLUMNS, min_child=0.5, split_penalty=0)
    df = frame(spark, x, label, odd=True)
    model = spec.fit(df)
    train.save(model, str(tmp_path / "model"))
    again = train.load(str(tmp_path / "model"))
    assert again.columns == list(COLUMNS) and again.classes == 3 and again.missing is None
    expected = dict(enumerate(model.margins(model.values(table_of(x))).argmax(axis=1).tolist()))
    for predicted in (model.transform(df, 10**6), model.transform(df, 0), again.transform(df), again.transform_batches(df)):
        assert predicted.columns == [*df.columns, "prediction"]
        assert {r.k: r.prediction for r in predicted.collect()} == expected
    # The layout of the rows hardly matters (equal gains part by rounding), a column of predictions not at all.
    other = spec.fit(df.repartition(7))
    assert np.mean([a.argmax() == b.argmax() for a, b in zip(*[m.margins(m.values(table_of(x))) for m in (model, other)])]) > 0.95
    assert again.transform(df.withColumn("prediction", F.lit("x"))).schema["prediction"].dataType.typeName() == "double"


def test_directions_of_missing_values_are_learnt(spark):
    x, label = examples(600, 5)
    spec = Softmax(rounds=5, max_depth=3, learning_rate=0.5, classes=3, columns=COLUMNS, subsample=1, column_sample=1)
    model = spec.fit(frame(spark, x, label))
    only = np.array([[np.nan, np.nan, np.nan], [np.nan, np.nan, 0.1]])
    margins = model.margins(only)
    # A missing third feature speaks for label 2, a known one against it.
    assert margins[0, 2] > margins[1, 2]
    # A number can stand for missing values, as zeros do when rows are scored elsewhere.
    zeros = np.where(np.isnan(x), 0.0, np.where(x == 0, 1e-9, x))
    coded = Softmax(**{**spec.__dict__, "missing": 0.0})
    same = coded.fit(frame(spark, zeros, label))
    assert (same.margins(same.cleaned(zeros)).argmax(axis=1) == model.margins(x).argmax(axis=1)).mean() > 0.97
    df = frame(spark, zeros, label)
    assert same.transform(df).exceptAll(same.transform_batches(df)).isEmpty()


def test_odd_rows(spark):
    spec = Softmax(rounds=2, max_depth=3, classes=3, columns=COLUMNS)
    x, label = examples(60, 1)
    model = spec.fit(frame(spark, x, label).limit(0))
    assert {r.prediction for r in model.transform(frame(spark, x, label)).collect()} == {0.0}
    # Constant and empty columns have no borders; one class alone still trains.
    flat = spec.fit(frame(spark, np.full((30, 3), np.nan), np.ones(30, int)))
    assert {r.prediction for r in flat.transform(frame(spark, x, label)).collect()} == {1.0}
    infinite = np.where(np.isnan(x), np.inf, x)
    infinite[infinite[:, 0] < -0.5, 0] = -np.inf
    infinite[infinite[:, 2] < 0, 2] = -np.inf
    sharp = Softmax(rounds=2, max_depth=3, classes=3, columns=COLUMNS, min_child=0.5, split_penalty=0, learning_rate=0.5)
    model, df = sharp.fit(frame(spark, infinite, label)), frame(spark, infinite, label)
    for leaves in (0, 10**6):
        assert model.transform(df, leaves).exceptAll(model.transform_batches(df)).isEmpty()
    with pytest.raises(ValueError, match="bins"):
        Softmax(bins=255, columns=COLUMNS, classes=3).fit(frame(spark, x, label))


def test_penalties_and_losses(spark):
    x, label = examples(300, 2)
    df = frame(spark, x, label).withColumn("state", F.col("label").cast("string"))
    quick = dict(rounds=4, max_depth=4, learning_rate=0.3, classes=3, columns=COLUMNS)
    model = Softmax(**quick).fit(df)
    losses = train.round_losses(model, {"train": df}).orderBy("step").collect()
    assert [r.step for r in losses] == [0, 1, 2, 3] and losses[0].loss < math.log(3)
    assert all(a.loss > b.loss for a, b in zip(losses, losses[1:])) and losses[-1].error < 0.2
    margins = model.margins(model.values(table_of(x)))
    e = np.exp(margins)
    assert losses[-1].loss == pytest.approx(-np.log(e[np.arange(300), label] / e.sum(axis=1)).mean())
    # A large penalty leaves the roots, whose values make the commonest class win.
    barren = Softmax(**quick, split_penalty=1e6).fit(df)
    assert all(len(t.feature) == 1 for r in barren.rounds for t in r)
    assert {r.prediction for r in barren.transform(df).collect()} == {float(np.bincount(label).argmax())}


def test_a_tree_of_many_nodes_is_grafted():
    inner = boosting.Growing()
    a, b = inner.split(0, 1, 2, True)
    inner.split(b, 0, 3, False)
    inner.value = [float(k) for k in range(5)]
    outer = boosting.Growing()
    left, _ = outer.split(0, 2, 1, False)
    outer.graft(left, inner)
    bins = np.array([[0, 0, 0], [4, 3, 1], [9, 3, 1], [0, 0, 5], [0, 255, 0]], np.uint8)
    values = np.array(outer.value)[outer.leaves(bins)]
    assert values.tolist() == [1.0, 4.0, 4.0, 0.0, 1.0]
    tree = outer.finished([np.arange(9.0)] * 3)
    assert isinstance(tree, Tree) and tree.depth() == 3
    assert SoftmaxTrees([[tree]], ["x", "y", "z"], 1).margins(bins.astype(float))[1, 0] == pytest.approx(4.5)
