"""Multi-class boosted trees with one softmax objective, grown on Spark.

Every round grows one tree per class on the gradients of the softmax loss. Features are cut
into quantile bins once, and rows stored as bins. A level of large nodes is one job: tasks
sum gradients per node, feature and bin, the sums are added up by Spark, and the best split
of every node comes back. Nodes with few rows are finished in one more job, each by the
task its rows are sent to. Margins are computed from the trees so far wherever rows are
read, so nothing is written between rounds.

Missing values have a bin of their own; a split sends them to the side where they gain
more.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlewave.model.trees import BASE_MARGIN, SoftmaxTrees, Tree
from spindlewave.schema import PIVOT_FEATURES, WEAR_STATES
from spindlewave.session import remove_folder, work_dir

MISSING = 255  # the bin of missing values
CELLS = 1 << 21  # sums that a task holds at once
TINY = 1e-6
ROWS = 20_000  # rows that are worth a task, at least


@dataclass
class Growing:
    """A tree over bins: node by node, the root first. ``feature`` is -1 in leaves."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int, missing_left: bool) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.bin[node], self.missing_left[node] = feature, at, missing_left
        self.left[node], self.right[node] = left, left + 1
        for _ in range(2):
            self.feature.append(-1)
            self.bin.append(0)
            self.missing_left.append(False)
            self.left.append(-1)
            self.right.append(-1)
            self.value.append(0.0)
        return left, left + 1

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        feature, at, missing, left, right = (
            np.array(x) for x in (self.feature, self.bin, self.missing_left, self.left, self.right)
        )
        node = np.zeros(len(bins), np.int64)
        going = np.flatnonzero(feature[node] >= 0)
        while len(going):
            own = node[going]
            value = bins[going, feature[own]]
            node[going] = np.where(np.where(value == MISSING, missing[own], value <= at[own]), left[own], right[own])
            going = going[feature[node[going]] >= 0]
        return node

    def graft(self, node: int, other: Growing) -> None:
        """Put the tree ``other`` in the place of a leaf."""
        places = {0: node}
        for k in range(len(other.feature)):
            own = places[k]
            self.value[own] = other.value[k]
            if other.feature[k] >= 0:
                sides = self.split(own, other.feature[k], other.bin[k], other.missing_left[k])
                places[other.left[k]], places[other.right[k]] = sides

    def finished(self, borders: Sequence[np.ndarray]) -> Tree:
        feature = np.array(self.feature, int)
        # An infinite border would have no literal.
        least = -np.finfo(float).max
        border = [max(least, borders[f][b]) if f >= 0 else 0.0 for f, b in zip(self.feature, self.bin, strict=True)]
        return Tree(
            feature, np.array(border, float), np.array(self.missing_left, bool), np.array(self.left, int),
            np.array(self.right, int), np.array(self.value, float),
        )


@dataclass(frozen=True)
class Softmax:
    """The estimator. ``min_child`` is the least sum of second derivatives in a child, ``split_penalty`` the
    least gain of a split, summed over its rows, ``ridge`` the weight of squared leaf values."""

    rounds: int = 10
    max_depth: int = 12
    learning_rate: float = 0.007
    subsample: float = 0.7
    column_sample: float = 0.7
    min_child: float = 3
    split_penalty: float = 0.1
    ridge: float = 2
    classes: int = len(WEAR_STATES)
    seed: int = 1000
    bins: int = 128
    local_rows: int = 100_000  # nodes with no more rows are finished by one task
    columns: tuple[str, ...] = PIVOT_FEATURES
    missing: float | None = None

    def parameters(self) -> dict[str, object]:
        return {name: value for name, value in asdict(self).items() if name != "columns"}

    def fit(self, rows: DataFrame) -> SoftmaxTrees:
        """Train on rows with the feature columns and the class number ``label``."""
        return _Run(self, rows).fit()

    def leaf(self, g, h):
        return -self.learning_rate * g / (h + self.ridge)


def gradients(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives [rows, classes] of the softmax loss."""
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    p = e / e.sum(axis=1, keepdims=True)
    g = p.copy()
    g[np.arange(len(label)), label] -= 1
    return g, np.maximum(2 * p * (1 - p), 1e-16)


def best_splits(spec: Softmax, g: np.ndarray, h: np.ndarray, allowed: np.ndarray, limits: np.ndarray):
    """Per node: gain, feature, bin and whether missing values go left; gain 0 where nothing gains enough.

    ``g`` and ``h`` are sums [nodes, features, bins + 1], missing values last; ``allowed``
    [nodes, features] are a tree's columns, ``limits`` the number of borders of each feature.
    """
    nodes, features, width = g.shape
    bins = width - 1
    gt, ht = (v.sum(axis=2)[:, :1, None] for v in (g, h))
    whole = gt**2 / (ht + spec.ridge)
    good = allowed[:, :, None] & (np.arange(bins)[None, None, :] < limits[None, :, None])
    gains = []
    for to_left in (True, False):
        gl, hl = (np.cumsum(v[:, :, :bins], axis=2) + (v[:, :, bins:] if to_left else 0) for v in (g, h))
        gr, hr = gt - gl, ht - hl
        gain = gl**2 / (hl + spec.ridge) + gr**2 / (hr + spec.ridge) - whole
        gains.append(np.where(good & (hl >= spec.min_child) & (hr >= spec.min_child), gain, 0.0))
    both = np.stack(gains, axis=3).reshape(nodes, -1)
    best = both.argmax(axis=1)
    gain = both[np.arange(nodes), best]
    gain = np.where((gain > TINY) & (gain >= spec.split_penalty), gain, 0.0)
    return gain, best // (2 * bins), best // 2 % bins, best % 2 == 0


def sums(bins: np.ndarray, node: np.ndarray, nodes: int, width: int, values: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Sums of each value per node, feature and bin [nodes, features, width]; the last bin is that of missing ones."""
    features = bins.shape[1]
    place = np.minimum(bins, width - 1).astype(np.int64) + np.arange(features) * width
    place = (place + (node * (features * width))[:, None]).ravel()
    size = nodes * features * width
    return [np.bincount(place, np.repeat(v, features), size).reshape(nodes, features, width) for v in values]


def grow(spec: Softmax, bins: np.ndarray, g: np.ndarray, h: np.ndarray, allowed: np.ndarray, limits: np.ndarray, depth: int) -> Growing:
    """The tree over all rows given, at most ``depth`` deep, level by level."""
    tree = Growing()
    node = np.zeros(len(bins), np.int64)
    tree.value[0] = float(spec.leaf(g.sum(), h.sum()))
    # Only nodes that can still be split are counted.
    open_nodes = [0]
    width = int(limits.max(initial=0)) + 2
    for _ in range(depth):
        if not open_nodes:
            break
        spot = np.full(len(tree.feature), -1)
        spot[open_nodes] = np.arange(len(open_nodes))
        at = np.flatnonzero(spot[node] >= 0)
        following = []
        step = max(1, CELLS // (bins.shape[1] * width))
        for a in range(0, len(open_nodes), step):
            own = open_nodes[a : a + step]
            part = at[(spot[node[at]] >= a) & (spot[node[at]] < a + step)]
            gs, hs = sums(bins[part], spot[node[part]] - a, len(own), width, (g[part], h[part]))
            gain, feature, place, missing_left = best_splits(spec, gs, hs, np.tile(allowed, (len(own), 1)), limits)
            for k, n in enumerate(own):
                if gain[k] > 0:
                    following += tree.split(n, int(feature[k]), int(place[k]), bool(missing_left[k]))
        inner = np.flatnonzero(np.array(tree.feature)[node] >= 0)
        feature, place, missing, left, right = (
            np.array(x) for x in (tree.feature, tree.bin, tree.missing_left, tree.left, tree.right)
        )
        own = node[inner]
        value = bins[inner, feature[own]]
        goes = np.where(value == MISSING, missing[own], value <= place[own])
        node[inner] = np.where(goes, left[own], right[own])
        gn, hn = (np.bincount(node, v, len(tree.feature)) for v in (g, h))
        for n in following:
            tree.value[n] = float(spec.leaf(gn[n], hn[n]))
        open_nodes = [n for n in following if hn[n] >= 2 * spec.min_child]
    return tree


SUBTREE = (
    "tree int, node int, feature array<int>, bin array<int>, missing_left array<boolean>, left array<int>, "
    "right array<int>, value array<double>"
)


class _Run:
    """One training run: the rows as bins in a stored table, and the trees so far."""

    def __init__(self, spec: Softmax, rows: DataFrame):
        if not 2 <= spec.bins < MISSING:
            raise ValueError(f"bins must lie between 2 and {MISSING - 1}")
        self.spec = spec
        self.spark = rows.sparkSession
        self.borders = self._borders(rows)
        self.limits = np.array([len(b) for b in self.borders])
        self.path = work_dir(self.spark, "bins")
        self._binned(rows).write.parquet(self.path)
        self.rows = self.spark.read.parquet(self.path)
        self.total = self.rows.count()
        self.rows = self.rows.coalesce(max(1, self.total // ROWS))
        self.done: list[list[Growing]] = []

    def _value(self, name: str) -> Column:
        value = F.col(f"`{name}`").cast("double")
        odd = F.isnan(value)
        if self.spec.missing is not None:
            odd = odd | (value == F.lit(float(self.spec.missing)))
        return F.when(~odd, value)

    def _borders(self, rows: DataFrame) -> list[np.ndarray]:
        """Different quantiles of every feature, without its largest value."""
        shares = [k / self.spec.bins for k in range(1, self.spec.bins)]
        found = rows.agg(*[
            F.struct(F.percentile_approx(self._value(n), shares, 100 * self.spec.bins).alias("q"), F.max(self._value(n)).alias("top"))
            for n in self.spec.columns
        ]).first()
        return [np.array([q for q in np.unique(cell["q"] or []) if q < cell["top"]], float) for cell in found]

    def _binned(self, rows: DataFrame) -> DataFrame:
        """key (a hash of the row, by which rows are sampled), label and bins of every row."""
        columns, borders = self.spec.columns, self.borders
        key = F.xxhash64(F.lit(self.spec.seed), *[F.col(f"`{f.name}`") for f in rows.schema if _hashable(f.dataType)])
        chosen = rows.select(key.alias("__key"), F.col("label").cast("int").alias("__label"), *[self._value(n).alias(f"__x{k}") for k, n in enumerate(columns)])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = np.empty((len(batch), len(columns)), np.uint8)
                for k, border in enumerate(borders):
                    x = np.asarray(batch.column(f"__x{k}").fill_null(np.nan))
                    found[:, k] = np.where(np.isnan(x), MISSING, np.searchsorted(border, x, "left"))
                cells = pa.array([row.tobytes() for row in found], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("__key"), batch.column("__label"), cells], ["key", "label", "bins"])

        return chosen.mapInArrow(cut, "key long, label int, bins binary")

    def fit(self) -> SoftmaxTrees:
        random = np.random.default_rng(self.spec.seed)
        features = len(self.spec.columns)
        number = max(1, round(features * self.spec.column_sample))
        try:
            for _ in range(self.spec.rounds):
                allowed = np.zeros((self.spec.classes, features), bool)
                for k in range(self.spec.classes):
                    allowed[k, random.choice(features, number, replace=False)] = True
                self.done.append(self._round(allowed))
        finally:
            remove_folder(self.spark, self.path)
        rounds = [[tree.finished(self.borders) for tree in trees] for trees in self.done]
        return SoftmaxTrees(rounds, list(self.spec.columns), self.spec.classes, self.spec.missing)

    def _round(self, allowed: np.ndarray) -> list[Growing]:
        spec = self.spec
        trees = [Growing() for _ in range(spec.classes)]
        open_nodes = {(k, 0): (self.total, spec.max_depth) for k in range(spec.classes)}  # rows, levels left
        while True:
            large = sorted(key for key, (n, left) in open_nodes.items() if n > spec.local_rows and left > 0)
            if not large:
                break
            step = max(1, CELLS // (len(spec.columns) * (int(self.limits.max(initial=0)) + 2)))
            for a in range(0, len(large), step):
                group = large[a : a + step]
                # One row per node of the group.
                for row in self._splits(trees, group, allowed).collect():
                    key = (row.tree, row.node)
                    _, left = open_nodes.pop(key)
                    trees[row.tree].value[row.node] = float(spec.leaf(row.g, row.h))
                    if row.gain > 0:
                        sides = trees[row.tree].split(row.node, row.feature, row.bin, row.missing_left)
                        for side, n in zip(sides, (row.n_left, row.n - row.n_left), strict=True):
                            open_nodes[(row.tree, side)] = (n, left - 1)
                for key in group:
                    open_nodes.pop(key, None)  # a node without sampled rows stays a leaf
        if open_nodes:
            # One row per node; together they are the rest of the trees.
            for row in self._subtrees(trees, open_nodes, allowed).collect():
                names = ("feature", "bin", "missing_left", "left", "right", "value")
                trees[row.tree].graft(row.node, Growing(*[list(row[name]) for name in names]))
        return trees

    def _sampled(self) -> Column:
        if self.spec.subsample >= 1:
            return F.lit(True)
        share = F.pmod(F.xxhash64("key", F.lit(len(self.done))), F.lit(1 << 30)) / F.lit(float(1 << 30))
        return share < self.spec.subsample

    def _shared(self, *things):
        return self.spark.sparkContext.broadcast(cloudpickle.dumps((self.spec, self.done, *things)))

    def _splits(self, trees: list[Growing], group: list[tuple[int, int]], allowed: np.ndarray) -> DataFrame:
        """The best split of each node of ``group``, with the sums of its rows."""
        shared = self._shared(trees, group, allowed, self.limits)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            spec, done, trees, group, allowed, limits = pickle.loads(shared.value)
            features, width = len(spec.columns), int(limits.max(initial=0)) + 2
            total = np.zeros((3, len(group), features, width))
            for batch in batches:
                bins, g, h = _derived(batch, spec, done)
                for k, tree in enumerate(trees):
                    spot = np.full(len(tree.feature), -1)
                    for at, (own, node) in enumerate(group):
                        if own == k:
                            spot[node] = at
                    if (spot < 0).all():
                        continue
                    place = spot[tree.leaves(bins)]
                    rows = np.flatnonzero(place >= 0)
                    ones = np.ones(len(rows))
                    total += np.stack(sums(bins[rows], place[rows], len(group), width, (g[rows, k], h[rows, k], ones)))
            node, feature, at = np.nonzero(total[2])
            keys = np.array(group, np.int32).reshape(-1, 2)[node]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (keys[:, 0], keys[:, 1], feature.astype(np.int32), at.astype(np.int32), *(t[node, feature, at] for t in total))],
                ["tree", "node", "feature", "bin", "g", "h", "n"],
            )

        cells = self.rows.where(self._sampled()).mapInArrow(count, "tree int, node int, feature int, bin int, g double, h double, n double")
        cells = cells.groupBy("tree", "node", "feature", "bin").agg(*[F.sum(v).alias(v) for v in ("g", "h", "n")])
        cells = cells.groupBy("tree", "node").agg(F.sort_array(F.collect_list(F.struct("feature", "bin", "g", "h", "n"))).alias("cells"))

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            spec, _, _, _, allowed, limits = pickle.loads(shared.value)
            features, width = len(spec.columns), int(limits.max(initial=0)) + 2
            for batch in batches:
                for row in batch.to_pylist():
                    cells = row["cells"]
                    total = np.zeros((3, 1, features, width))
                    f, b = (np.array([c[name] for c in cells]) for name in ("feature", "bin"))
                    for k, name in enumerate(("g", "h", "n")):
                        total[k, 0, f, b] = [c[name] for c in cells]
                    own = allowed[row["tree"]][None, :]
                    gain, feature, at, left = (x[0] for x in best_splits(spec, total[0], total[1], own, limits))
                    here = total[2, 0, feature]
                    n_left = here[: at + 1].sum() + (here[-1] if left else 0)
                    g, h, n = (t[0, 0].sum() for t in total)
                    found = (row["tree"], row["node"], gain, feature, at, left, g, h, n, n_left)
                    kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
                    arrays = [pa.array([kind_of(kind)(x)], kind) for x, kind in zip(found, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names)

        names = ["tree", "node", "gain", "feature", "bin", "missing_left", "g", "h", "n", "n_left"]
        schema = "tree int, node int, gain double, feature int, bin int, missing_left boolean, g double, h double, n long, n_left long"
        return cells.mapInArrow(choose, schema)

    def _subtrees(self, trees: list[Growing], open_nodes: dict, allowed: np.ndarray) -> DataFrame:
        """The trees below the open nodes, each grown from its rows by one task."""
        shared = self._shared(trees, open_nodes, allowed, self.limits)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            spec, done, trees, open_nodes, _, _ = pickle.loads(shared.value)
            for batch in batches:
                bins, g, h = _derived(batch, spec, done)
                for k, tree in enumerate(trees):
                    node = tree.leaves(bins)
                    rows = np.flatnonzero(np.isin(node, [n for own, n in open_nodes if own == k]))
                    columns = [pa.array(np.full(len(rows), k, np.int32)), pa.array(node[rows].astype(np.int32)),
                               batch.column("bins").take(pa.array(rows)), pa.array(g[rows, k]), pa.array(h[rows, k])]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "bins", "g", "h"])

        dealt = self.rows.where(self._sampled()).mapInArrow(deal, "tree int, node int, bins binary, g double, h double")
        dealt = dealt.repartition("tree", "node").sortWithinPartitions("tree", "node")

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            spec, _, _, open_nodes, allowed, limits = pickle.loads(shared.value)
            key, held = None, []

            def out() -> pa.RecordBatch:
                bins, g, h = (np.concatenate(x) for x in zip(*held, strict=True))
                tree = grow(spec, bins, g, h, allowed[key[0]], limits, open_nodes[key][1])
                lists = (tree.feature, tree.bin, tree.missing_left, tree.left, tree.right, tree.value)
                kinds = (pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.float64())
                arrays = [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32())]
                arrays += [pa.array([x], pa.list_(kind)) for x, kind in zip(lists, kinds, strict=True)]
                return pa.RecordBatch.from_arrays(arrays, ["tree", "node", "feature", "bin", "missing_left", "left", "right", "value"])

            for batch in batches:
                bins = _bins(batch, len(spec.columns))
                own = np.stack([np.asarray(batch.column(n)) for n in ("tree", "node")], axis=1)
                g, h = (np.asarray(batch.column(n)) for n in ("g", "h"))
                ends = [0, *(np.flatnonzero((own[1:] != own[:-1]).any(axis=1)) + 1).tolist(), len(own)]
                for a, b in zip(ends[:-1], ends[1:], strict=True):
                    if b == a:
                        continue
                    here = (int(own[a, 0]), int(own[a, 1]))
                    if here != key and held:
                        yield out()
                        held = []
                    key = here
                    held.append((bins[a:b], g[a:b], h[a:b]))
            if held:
                yield out()

        return dealt.mapInArrow(finish, SUBTREE)


def kind_of(kind: pa.DataType) -> type:
    return bool if pa.types.is_boolean(kind) else float if pa.types.is_floating(kind) else int


def _hashable(kind) -> bool:
    return kind.typeName() not in ("map", "variant", "udt", "vector")


def _bins(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)


def _derived(batch: pa.RecordBatch, spec: Softmax, done: list[list[Growing]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bins of a batch, and the gradients of its rows after the rounds done."""
    bins = _bins(batch, len(spec.columns))
    margin = np.full((len(bins), spec.classes), BASE_MARGIN)
    for trees in done:
        for k, tree in enumerate(trees):
            margin[:, k] += np.array(tree.value)[tree.leaves(bins)]
    return bins, *gradients(margin, np.asarray(batch.column("label")))
