"""Near-duplicate vectors: tiles compared along principal components, with early stops.

Vectors are turned to their principal axes, which changes no cosine. The leading axes
come first: after some of them a pair's product can grow by no more than the product
of the two lengths that are left, and pairs that cannot reach the threshold are
dropped. On the three leading axes linked vectors lie less than ``reach`` apart, so
vectors are dealt to the cells of a grid of that width and only tiles of neighbouring
cells are compared. A cell with many vectors is cut into tiles.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlewave.llm import vectors as V
from spindlewave.llm.common import dropped, stored
from spindlewave.llm.components import components, forest
from spindlewave.session import settings

AXES = 3  # of the grid; a unit vector has at most (2 / reach + 2) ** 3 cells
TILE = 4096
GROUP = 8  # tiles that travel together, or the rows of so many
WIDER = (2, 4, 8)  # sides of groups of cells, in cells
ROWS = 512  # of a tile, against all of another, at once
SPARSE = 0.02  # share of pairs below which they are listed one by one
FIRST = 0.1  # what the axes must leave the bound below the threshold, on average, to be worth a stop
ROUGH = 1e-4  # more than single precision can err
CLOSE = 1e-9  # nearer to the threshold than this, the cosine of the given vectors decides
LISTED = 50_000  # pairs whose vectors are laid side by side at once


def stops(dim: int) -> list[int]:
    """Numbers of leading axes after which pairs are dropped: 8, 16, 32, ... and all."""
    found = [8]
    while found[-1] < dim:
        found.append(found[-1] * 2)
    return [*found[:-1], dim] if found[-1] >= dim else found


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """For each number of components the axes (columns), from all vectors, largest share first.

    Tasks add up products of their own vectors; their sums are added in a few groups,
    so that the driver receives a few matrices.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in V.by_dim(batch):
                y = V.unit_rows(V.matrix(part.column("data"), dim))
                sums[dim] = sums.get(dim, 0) + y.T @ y
        yield as_rows(sums)

    def as_rows(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        data = [x.astype("<f8").tobytes() for x in sums.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(data, pa.binary())], ["dim", "sums"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, data in zip(batch.column("dim").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                sums[dim] = sums.get(dim, 0) + np.frombuffer(data, "<f8").reshape(dim, dim)
        yield as_rows(sums)

    parts = classes.select("dim", "data").mapInArrow(moments, "dim int, sums binary")
    rows = parts.repartition(8).mapInArrow(add, "dim int, sums binary").collect()
    total: dict[int, np.ndarray] = {}
    for row in rows:
        total[row["dim"]] = total.get(row["dim"], 0) + np.frombuffer(row["sums"], "<f8").reshape(row["dim"], -1)
    return {dim: np.linalg.eigh(x)[1][:, ::-1].copy() for dim, x in total.items()}


def linked(
    a: np.ndarray, b: np.ndarray, turned_a: np.ndarray, turned_b: np.ndarray, least: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of unit vectors a[i], b[j] whose cosine is at least ``least``, in runs.

    The bound after some axes is itself a product: of the leading components and, as one
    more, the length of the rest. It is taken in single precision with a margin for
    that; what survives goes on in double precision.
    """
    dim = a.shape[1]
    ends = stops(dim)
    rest_a = np.stack([np.sqrt((turned_a[:, e:] ** 2).sum(axis=1)) for e in ends])
    rest_b = np.stack([np.sqrt((turned_b[:, e:] ** 2).sum(axis=1)) for e in ends])
    # Axes that leave nearly everything open drop no pairs: begin behind them.
    left = rest_a.mean(axis=1) * rest_b.mean(axis=1)
    first = int(np.argmax(left <= least - FIRST))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def bound(k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in bounds:
            sides = ((turned_a, rest_a[k]), (turned_b, rest_b[k]))
            bounds[k] = tuple(np.column_stack([x[:, : ends[k]], r]).astype(np.float32) for x, r in sides)
        return bounds[k]

    def products(i: np.ndarray, j: np.ndarray, begin: int, end: int) -> np.ndarray:
        found = np.empty(len(i))
        for x in range(0, len(i), LISTED):
            y = slice(x, x + LISTED)
            found[y] = np.einsum("nd,nd->n", turned_a[i[y], begin:end], turned_b[j[y], begin:end])
        return found

    for row in range(0, len(a), ROWS):
        top, k = slice(row, row + ROWS), first
        while ends[k] < dim:
            own, other = bound(k)
            may = own[top] @ other.T >= np.float32(least - ROUGH)
            if np.count_nonzero(may) <= SPARSE * may.size:
                break
            k += 1
        if ends[k] < dim:
            i, j = np.nonzero(may)
            i += row
            product = products(i, j, 0, ends[k])
        else:
            whole = turned_a[top] @ turned_b.T
            i, j = np.nonzero(whole >= least - CLOSE)
            product, i = whole[i, j], i + row
        for begin, end, at in zip(ends[k:], ends[k + 1 :], range(k + 1, len(ends)), strict=False):
            product = product + products(i, j, begin, end)
            alive = product + rest_a[at, i] * rest_b[at, j] >= least - CLOSE
            product, i, j = product[alive], i[alive], j[alive]
        unsure = np.flatnonzero(np.abs(product - least) <= CLOSE)
        for x in range(0, len(unsure), LISTED):
            y = unsure[x : x + LISTED]
            product[y] = np.einsum("nd,nd->n", a[i[y]], b[j[y]])
        sure = product >= least
        if sure.any():
            yield i[sure], j[sure]


def near_vectors(vectors: DataFrame, least: float = 0.95, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Vectors are linked if their cosine is at least ``least`` (above 0). Vectors that are
    null, empty, zero or hold null or non-finite components, and vectors of different
    lengths, are not linked. Rows that share an id are one vector for components and
    link through each; n_links counts other rows, for all vectors of the id that come
    first among their equals. Rows without an id link with nothing,
    have no component and are kept. Other columns are not read.
    """
    spark = vectors.sparkSession
    base = stored(V.readable(vectors, id_column, column), "vectors")
    valid = base.where("data is not null and vec_id is not null")
    classes = valid.groupBy("data").agg(
        F.min("vec_id").alias("node"), F.first("dim").alias("dim"), F.count(F.lit(1)).alias("copies")
    )
    classes = stored(classes, "classes")
    axes = spark.sparkContext.broadcast(principal_axes(classes))
    reach = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-6

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in V.by_dim(batch):
                y = V.unit_rows(V.matrix(part.column("data"), dim)) @ axes.value[dim][:, :AXES]
                places = np.zeros((len(part), AXES), np.int32)
                places[:, : y.shape[1]] = np.floor(y / reach)
                columns = [pa.array(places[:, k]) for k in range(AXES)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name) for name in ("node", "dim", "copies", "data")), *columns],
                    ["node", "dim", "copies", "data", "x", "y", "z"],
                )

    dealt = classes.select("node", "dim", "copies", "data").mapInArrow(
        cells, "node long, dim int, copies long, data binary, x int, y int, z int"
    )
    dealt = stored(dealt, "cells")
    cell = ["dim", "x", "y", "z"]
    chunks = dealt.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    chunks = stored(chunks.withColumn("chunks", F.ceil(F.col("n") / TILE).cast("int")), "grid")
    dealt = dealt.join(chunks.drop("n"), cell)
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("data"), F.col("chunks")).cast("int"))
    key = [*cell, "chunk"]
    ordered = dealt.select(*key, "node", "copies", "data").repartition(*key).sortWithinPartitions(*key)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        rows: list[list] = [[], [], []]

        def out() -> pa.RecordBatch:
            nodes, copies = (np.array(x, "<i8").tobytes() for x in rows[:2])
            data = np.frombuffer(b"".join(rows[2]), "<f8")
            # Vectors that single precision holds as they are travel in it.
            with np.errstate(over="ignore", under="ignore"):
                single = data.astype("<f4")
            values = [*held, nodes, copies, (single if (single == data).all() else data).tobytes()]
            types = [pa.int32()] * len(key) + [pa.binary()] * 3
            arrays = [pa.array([value], t) for value, t in zip(values, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, [*key, "nodes", "copies", "data"])

        for batch in batches:
            keys = zip(*(batch.column(name).to_pylist() for name in key), strict=True)
            items = zip(*(batch.column(name).to_pylist() for name in ("node", "copies", "data")), strict=True)
            for at, item in zip(keys, items, strict=True):
                if at != held:
                    if held is not None:
                        yield out()
                    held, rows = at, [[], [], []]
                for place, value in zip(rows, item, strict=True):
                    place.append(value)
        if held is not None:
            yield out()

    fields = ", ".join(f"{name} int" for name in key) + ", nodes binary, copies binary, data binary"
    tiles = ordered.mapInArrow(pack, fields).withColumn("tile", F.concat_ws("/", *key))
    tiles = stored(tiles, "tiles", compression="none")

    near = F.array(*(F.array(*map(F.lit, d)) for d in itertools.product((-1, 0, 1), repeat=AXES)))
    places = tiles.select("tile", *cell, groups_of(chunks, cell).alias("group"))
    around = places.withColumn("d", F.explode(near)).select(
        F.col("tile").alias("a"), F.col("dim").alias("of"), F.col("group").alias("group_a"),
        *((F.col(name) + F.col("d")[k]).alias(f"to_{name}") for k, name in enumerate(("x", "y", "z"))),
    )
    same = [F.col("of") == F.col("dim"), *(F.col(f"to_{name}") == F.col(name) for name in ("x", "y", "z"))]
    pairs = around.join(places.withColumnRenamed("tile", "b"), same).where("a <= b")
    # Pairs are dealt by the groups of their tiles, so a tile travels once for each group that it meets.
    block = F.concat_ws(" ", F.least("group_a", "group"), F.greatest("group_a", "group"))
    pairs = stored(pairs.select(block.alias("block"), "a", "b"), "tile-pairs")
    members = pairs.select("block", F.col("a").alias("own")).union(pairs.select("block", "b")).distinct()
    held = members.join(tiles, F.col("own") == F.col("tile"))
    none = [F.lit(None).cast(kind) for kind in ("int", "binary", "binary", "binary")]
    rows = held.select("block", F.lit(0).alias("kind"), F.col("tile").alias("a"), F.lit("").alias("b"), "dim", "nodes", "copies", "data")
    rows = rows.union(pairs.select("block", F.lit(1), "a", "b", *none))
    rows = rows.repartition("block").sortWithinPartitions("block", "kind", "a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, at = {}, None
        for batch in batches:
            for row in range(len(batch)):
                block, kind, a, b = (batch.column(name)[row].as_py() for name in ("block", "kind", "a", "b"))
                if block != at:
                    known, at = {}, block
                if kind == 0:
                    known[a] = Tile(*(batch.column(name)[row].as_py() for name in ("dim", "nodes", "copies", "data")), axes.value)
                else:
                    yield from compare_tiles(known[a], known[b], a == b, least)

    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}):
        found = stored(rows.mapInArrow(compare, "u long, v long, n long"), "links")

    counts = found.where("n is not null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    counts = counts.withColumnRenamed("node", "counted")
    mark = F.xxhash64("data")
    several = valid.groupBy("vec_id").agg(F.min(mark).alias("p"), F.max(mark).alias("q")).where("p <> q")
    named = classes.select(F.col("data").alias("of_data"), "node", "copies")
    own = valid.join(several.select(F.col("vec_id").alias("of")), F.col("vec_id") == F.col("of"))
    own = own.join(named, F.col("data") == F.col("of_data")).select(F.col("vec_id").alias("u"), F.col("node").alias("v"))
    roots = components(found.where("n is null").select("u", "v").union(own))
    dropped(tiles, pairs)

    rows = base.withColumn("key", F.when(F.col("vec_id").isNotNull(), F.col("data")))
    rows = rows.join(named, F.col("key") == F.col("of_data"), "left")
    rows = rows.join(counts, F.col("node") == F.col("counted"), "left")
    rows = rows.withColumn("own", F.coalesce("node", "vec_id"))
    rows = rows.join(roots.toDF("of", "root"), F.col("own") == F.col("of"), "left")
    rows = rows.withColumn("component_id", F.coalesce("root", "own"))
    links = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("n", F.lit(0))
    return rows.select(
        "vec_id", links.cast("long").alias("n_links"), "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def groups_of(chunks: DataFrame, cell: list[str]) -> Column:
    """The group of a tile: those of GROUP chunks of a cell, or of as many cells on a side as GROUP tiles' rows allow."""
    side = 1
    for wider in WIDER:
        coarse = [F.floor(F.col(name) / wider).alias(name) for name in cell[1:]]
        most = chunks.groupBy(cell[0], *coarse).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
        if most is None or most > GROUP * TILE:
            break
        side = wider
    return F.concat_ws("/", cell[0], *(F.floor(F.col(name) / side) for name in cell[1:]), F.floor(F.col("chunk") / GROUP))


class Tile:
    """The vectors of a tile as unit rows, also turned to the principal axes."""

    def __init__(self, dim: int, nodes: bytes, copies: bytes, data: bytes, axes: dict[int, np.ndarray]):
        self.nodes, self.copies = np.frombuffer(nodes, "<i8"), np.frombuffer(copies, "<i8")
        kind = "<f8" if len(data) == 8 * dim * len(self.nodes) else "<f4"
        self.x = V.unit_rows(np.frombuffer(data, kind).astype(np.float64).reshape(-1, dim))
        self.turned = self.x @ axes[dim]


def compare_tiles(one: Tile, other: Tile, same: bool, least: float) -> Iterator[pa.RecordBatch]:
    """Link counts of both tiles' classes (u, null, n) and the forest of their links (u, v, null)."""
    names = ["u", "v", "n"]
    a, b, nodes_a, nodes_b, copies_a, copies_b = one.x, other.x, one.nodes, other.nodes, one.copies, other.copies
    total_a, total_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    for i, j in linked(a, b, one.turned, other.turned, least):
        if same:
            i, j = i[i != j], j[i != j]
        total_a += np.bincount(i, weights=copies_b[j], minlength=len(a)).astype(np.int64)
        if not same:
            total_b += np.bincount(j, weights=copies_a[i], minlength=len(b)).astype(np.int64)
        u, v = forest(nodes_a[i], nodes_b[j])
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.nulls(len(u), pa.int64())], names)
    for nodes, total in ((nodes_a, total_a), (nodes_b, total_b)):
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[some]), pa.nulls(len(some), pa.int64()), pa.array(total[some])], names
        )
