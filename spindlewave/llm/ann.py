"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample and every row is put in a leaf. A query takes
nodes from a priority queue by the distance of their centres, so leaves come in order
of promise. How many leaves a search visits is calibrated: for sample queries the true
neighbours are found among all rows, and visits are widened until the leaves visited
hold the wanted share of them. The leaves below one child of the root lie together, and
a query meets the rows of the leaves it visits there at once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindlewave.llm import vectors as V
from spindlewave.llm.common import hashed_sample, opened, shared, stored

#: Bounds of what is fitted on: rows for the tree, queries for the calibration.
SAMPLE, CALIBRATION = 20_000, 200
BRANCHES, LEAF = 16, 64  # children of a node; sample rows below which a node is a leaf
CELL = 32_768  # rows of a branch that are searched in one piece, on average
WIDER = 1.25  # factor by which visits are widened
QUERIES = 256  # queries compared with a piece at once


@dataclass
class Tree:
    """Nodes by number; node 0 is the root. A leaf has no children and a leaf number."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0
    branch: list[int] = field(default_factory=list)  # of each leaf: the child of the root above it

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child at each level."""
        found = np.zeros(len(x), np.int64)
        waiting = [(0, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            below = self.children[node]
            if not below:
                found[rows] = self.leaf[node]
                continue
            near = squares(x[rows], np.stack([self.centres[c] for c in below])).argmin(axis=1)
            for k, child in enumerate(below):
                mine = rows[near == k]
                if len(mine):
                    waiting.append((child, mine))
        return found

    def order(self, query: np.ndarray, visits: int | None = None) -> list[int]:
        """The first leaves that a best-bin-first search visits."""
        found: list[int] = []
        queue = [(0.0, 0)]
        while queue and (visits is None or len(found) < visits):
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                found.append(self.leaf[node])
                continue
            far = squares(query[None], np.stack([self.centres[c] for c in below]))[0]
            for distance, child in zip(far.tolist(), below, strict=True):
                heapq.heappush(queue, (distance, child))
        return found


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, rounded as products are: good for order, not for results."""
    return (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)


def means(x: np.ndarray, k: int, random: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """The cluster of each row, by Lloyd's rounds from rows drawn at random."""
    centres = x[random.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = squares(x, centres).argmin(axis=1)
        for c in np.unique(near):
            centres[c] = x[near == c].mean(axis=0)
    return squares(x, centres).argmin(axis=1)


def fit_tree(x: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF, seed: int = 0) -> Tree:
    """Cluster the sample, and each cluster again, until clusters are small or all alike."""
    random, tree = np.random.default_rng(seed), Tree()

    def grow(rows: np.ndarray, branch: int = -1) -> int:
        node = len(tree.centres)
        tree.centres.append(x[rows].mean(axis=0) if len(rows) else np.zeros(x.shape[1]))
        tree.children.append([])
        tree.leaf.append(-1)
        parts: list[np.ndarray] = []
        if len(rows) > leaf:
            near = means(x[rows], min(branches, -(-len(rows) // leaf)), random)
            parts = [rows[near == c] for c in np.unique(near)]
        if len(parts) < 2:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
            tree.branch.append(max(branch, 0))
        else:
            tree.children[node] = [grow(part, k if branch < 0 else branch) for k, part in enumerate(parts)]
        return node

    grow(np.arange(len(x)))
    return tree


def nearest(queries: np.ndarray, names: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, seen: np.ndarray | None = None):
    """For each query the places of its k nearest rows (other ids) and their exact distances.

    With ``seen`` [queries, rows] only the rows marked there count.

    Ties go to the smaller id. Products give an order with an error bound; whatever may
    be among the first k by that is measured exactly.
    """
    far = squares(queries, x)
    far[names[:, None] == ids[None, :]] = np.inf
    if seen is not None:
        far[~seen] = np.inf
    kth = np.partition(far, k - 1, axis=1)[:, k - 1] if k <= len(x) else np.full(len(queries), np.inf)
    size = (queries * queries).sum(axis=1) + (x * x).sum(axis=1).max(initial=0.0)
    for at, limit in enumerate(kth + 1e-9 * size):
        rows = np.flatnonzero((far[at] <= limit) & (far[at] < np.inf))
        exact = np.sqrt(((x[rows] - queries[at]) ** 2).sum(axis=1))
        best = np.lexsort((ids[rows], exact))[:k]
        yield rows[best], exact[best]


def top(found: DataFrame, k: int, keep: list[str]) -> DataFrame:
    """The k nearest of each query, with their rank."""
    first = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select(*keep)


def true_neighbours(rows: DataFrame, names: np.ndarray, x: np.ndarray, k: int) -> list:
    """(query_id, leaf) of the k nearest of all rows, for a bounded number of queries.

    Each task keeps the nearest of the rows it has seen.
    """
    sent = shared(rows.sparkSession, (names, x))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries = opened(sent)
        held = None
        for batch in batches:
            ids, leaf = np.asarray(batch.column("vec_id")), np.asarray(batch.column("leaf"))
            y = V.matrix(batch.column("data"), queries.shape[1])
            for a in range(0, len(y), CELL):
                part = slice(a, a + CELL)
                found = [
                    (int(name), float(score), int(ids[part][row]), int(leaf[part][row]))
                    for name, (places, scores) in zip(names, nearest(queries, names, y[part], ids[part], k), strict=True)
                    for row, score in zip(places, scores, strict=True)
                ]
                best: dict = {}
                for item in sorted(set((held or []) + found)):
                    mine = best.setdefault(item[0], [])
                    if len(mine) < k:
                        mine.append(item)
                held = [item for items in best.values() for item in items]
        columns = list(zip(*held, strict=True)) if held else [[], [], [], []]
        types = [pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["query_id", "score", "vec_id", "leaf"]
        )

    found = rows.select("vec_id", "leaf", "data").mapInArrow(scan, "query_id long, score double, vec_id long, leaf long")
    return top(found, k, ["query_id", "leaf"]).collect()


def calibrated(tree: Tree, rows: DataFrame, names: np.ndarray, x: np.ndarray, k: int, recall: float) -> int:
    """How many leaves to visit: widened until they hold the wanted share of true neighbours."""
    truth = true_neighbours(rows, names, x, k)
    places = {}
    for name, query in zip(names.tolist(), x, strict=True):
        places[name] = {leaf: at for at, leaf in enumerate(tree.order(query))}
    ranks = np.array([places[row["query_id"]][row["leaf"]] for row in truth])
    visits = 1
    while visits < tree.leaves and len(ranks) and (ranks < visits).mean() < recall:
        visits = max(visits + 1, int(visits * WIDER))
    return min(visits, tree.leaves)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, recall: float = 0.97,
    id_column: str = "vec_id", column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query by Euclidean distance.

    Both tables have an id and a vector. Rows without an id, and vectors that are null,
    empty, zero or hold null or non-finite components take no part. Vectors of one number
    of components are searched among themselves, with a tree of their own. A row with the
    query's own id is no candidate; equal rows count once; of several vectors of one query
    id the smallest (by its bytes) is searched. Ties go to the smaller id. Without candidates
    there are no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    base = stored(V.readable(vectors, id_column, column).where("data is not null and vec_id is not null"), "vectors")
    asked = V.readable(queries, id_column, column).where("data is not null and vec_id is not null")
    asked = asked.groupBy("vec_id").agg(F.min(F.struct("data", "dim")).alias("own")).select("vec_id", "own.data", "own.dim")
    dims = [row["dim"] for row in base.groupBy("dim").agg(F.count(F.lit(1))).orderBy("dim").collect()]
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = [search_one(base.where(F.col("dim") == dim), asked.where(F.col("dim") == dim), dim, k, recall) for dim in dims]
    return reduce(DataFrame.unionByName, found)


def search_one(base: DataFrame, asked: DataFrame, dim: int, k: int, recall: float) -> DataFrame:
    """``search`` of vectors with ``dim`` components, read as vec_id and data."""
    spark = base.sparkSession
    sample = hashed_sample(base, ["vec_id", "data"], SAMPLE).select("vec_id", "data").toArrow()
    x = V.matrix(sample.column("data").combine_chunks(), dim)
    tree = fit_tree(x)
    sent = shared(spark, tree)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = opened(sent)
        for batch in batches:
            leaf = tree.assign(V.matrix(batch.column("data"), dim))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(leaf), batch.column("data")], ["vec_id", "leaf", "data"]
            )

    rows = base.mapInArrow(index, "vec_id long, leaf long, data binary")
    rows = stored(rows, "index")
    names = np.asarray(sample.column("vec_id").combine_chunks())[:CALIBRATION]
    _, once = np.unique(names, return_index=True)
    visits = calibrated(tree, rows, names[once], x[:CALIBRATION][once], k, recall)

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = opened(sent)
        for batch in batches:
            for a in range(0, len(batch), QUERIES):
                part = batch.slice(a, QUERIES)
                at, branches, leaves = [], [], []
                for row, query in enumerate(V.matrix(part.column("data"), dim)):
                    below: dict[int, list[int]] = {}
                    for leaf in tree.order(query, visits):
                        below.setdefault(tree.branch[leaf], []).append(leaf)
                    at += [row] * len(below)
                    branches += below
                    leaves += below.values()
                part = part.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(branches, pa.int32()), pa.array(leaves, pa.list_(pa.int32())), part.column("data")],
                    ["vec_id", "branch", "leaves", "data"],
                )

    asked = asked.mapInArrow(traverse, "vec_id long, branch int, leaves array<int>, data binary")

    # A branch's rows in pieces; its queries meet every piece. There are at most BRANCHES branches.
    branch = F.element_at(F.lit(tree.branch), F.col("leaf").cast("int") + 1)
    placed = rows.withColumn("branch", branch)
    pieces = placed.groupBy("branch").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("pieces"))
    piece = F.pmod(F.xxhash64("vec_id"), F.col("pieces")).cast("int")
    left = placed.join(F.broadcast(pieces), "branch").select(
        "branch", piece.alias("piece"), F.lit(0).alias("side"), "vec_id", F.array(F.col("leaf").cast("int")).alias("leaves"), "data"
    )
    right = asked.join(F.broadcast(pieces), "branch").select(
        "branch", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(1).alias("side"), "vec_id", "leaves", "data"
    )
    cells = left.union(right).repartition("branch", "piece").sortWithinPartitions("branch", "piece", "side", "vec_id")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows, held = None, [], []
        ids, x, leaf = np.zeros(0, np.int64), np.zeros((0, dim)), np.zeros(0, np.int64)

        def settle() -> None:
            """Equal rows of a cell once, as arrays."""
            nonlocal ids, x, leaf, rows
            once = list(dict.fromkeys(rows))
            ids = np.array([name for name, _, _ in once], np.int64)
            leaf = np.array([at for _, at, _ in once], np.int64)
            x = np.frombuffer(b"".join(data for _, _, data in once), "<f8").reshape(-1, dim)
            rows = []

        def out() -> pa.RecordBatch:
            columns: list[list] = [[], [], []]
            seen = np.zeros((len(held), max(tree_leaves, 1)), bool)
            for at, (_, leaves, _) in enumerate(held):
                seen[at, leaves] = True
            some = np.flatnonzero(seen.any(axis=0)[leaf]) if len(leaf) else np.zeros(0, int)
            if len(some):
                names = np.array([name for name, _, _ in held], np.int64)
                asking = np.frombuffer(b"".join(data for _, _, data in held), "<f8").reshape(-1, dim)
                found = nearest(asking, names, x[some], ids[some], k, seen[:, leaf[some]])
                for name, (places, scores) in zip(names.tolist(), found, strict=True):
                    columns[0] += [name] * len(places)
                    columns[1] += scores.tolist()
                    columns[2] += ids[some][places].tolist()
            types = [pa.int64(), pa.float64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["query_id", "score", "vec_id"]
            )

        for batch in batches:
            keys = zip(batch.column("branch").to_pylist(), batch.column("piece").to_pylist(), strict=True)
            items = zip(*(batch.column(name).to_pylist() for name in ("side", "vec_id", "leaves", "data")), strict=True)
            for key, (side, name, leaves, data) in zip(keys, items, strict=True):
                if key != cell:
                    if held:
                        yield out()
                    cell, rows, held = key, [], []
                    settle()
                if side == 0:
                    rows.append((name, leaves[0], data))
                else:
                    if rows:
                        settle()
                    held.append((name, leaves, data))
                    if len(held) == QUERIES:
                        yield out()
                        held = []
        if held:
            yield out()

    tree_leaves = tree.leaves
    found = cells.mapInArrow(scan, "query_id long, score double, vec_id long")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return top(best, k, ["query_id", "rank", "vec_id", "score"])
