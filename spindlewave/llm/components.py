"""Connected components of links between integer ids, by union-find in tasks and star steps between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlewave.llm.common import dropped, stored

EDGE = "u long, v long"
AT_ONCE = 1 << 20  # links that one union-find holds


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over links: every node that is not the smallest of its tree, and that smallest.

    All links are handled at once: roots are hooked to smaller roots, paths are cut
    short, until no link joins two trees.
    """
    names, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    parent = np.arange(len(names))
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            inner = np.flatnonzero(parent != np.arange(len(names)))
            return names[inner], names[parent[inner]]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above


def contract(links: DataFrame) -> DataFrame:
    """Replace the links that a task holds by the star of each tree they form."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            u, v = forest(*(np.concatenate(x) for x in zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            held.append((np.asarray(batch.column("u")), np.asarray(batch.column("v"))))
            size += len(batch)
            if size >= AT_ONCE:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return links.select("u", "v").mapInArrow(merge, EDGE)


def star_step(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links after a large-star and a small-star step, and a table to drop then; u > v in every link."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = (
        both.join(least.withColumnRenamed("u", "k"), F.col("u") == F.col("k"))
        .where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )
    large = stored(large, "large-star")
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least.withColumnRenamed("u", "k"), F.col("u") == F.col("k"))
    small = small.select("v", "m").where("v <> m").union(least.select("u", "m"))
    return small.toDF("u", "v").distinct(), large


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest id reachable, for every node that is not its own root.

    ``links`` has integer columns u and v, in any order and number, without nulls;
    links from a node to itself are dropped. The result is a stored table with one
    row per node.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    links = stored(contract(links), "links")
    before = None
    while True:
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            return links.toDF("node", "root")
        before = mark
        after, large = star_step(links)
        after = stored(after, "small-star")
        dropped(links, large)
        links = after
