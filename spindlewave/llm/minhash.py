"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find grouping.

1. Each document's shingle set gets a SuperMinHash signature and its band keys. Equal
   sets form a class; from here on one document stands for its class.
2. In each bucket (band key) every member is compared with one leader, on full sets: the
   one that meets others in most buckets. The confirmed links are grouped by union-find.
3. Where a bucket still holds several components, members are compared with leaders of
   other components, and where that is not enough, those outside the largest component
   with all the bucket, in blocks. So a bucket's members are compared until they are
   known to be one component, without listing a group's pairs.

With 40 bands of 6 rows a pair of similarity 0.8 shares no bucket with a probability
of 5e-6; pairs of similarity 0.1 meet with one of 4e-5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.llm.common import dropped, mix, runs, stored, utf8
from spindlewave.llm.components import EDGE, components, forest
from spindlewave.llm.shingles import GOLDEN, shingle_sets

RUN = 1 << 19  # bytes of text handled at once in a task
LEADERS = 8  # orders of leaders among the bands
SHARES = 5_000  # a bucket with more than this part of all rows is joined apart
CELL = 100_000  # shingles on either side of one block, on average
ROW = 100  # what a set counts for in a block besides its shingles
MATCHES = 1 << 22  # shared shingles listed at once in a block
BITS = 27  # the bitmap of candidates has 2 ** BITS bits (16 MB), whatever their number
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def superminhash(members: np.ndarray, cut: np.ndarray, size: int) -> np.ndarray:
    """Signatures [sets, size] of non-empty sets.

    Every element draws a random permutation of the slots and a random fraction for
    each of its steps; in step j it offers j + fraction to the j-th slot of its
    permutation, and each slot keeps the least offer. A set is done as soon as all its
    slots are filled, since later steps offer more. Values are j in the high and the
    fraction in the low 32 bits.
    """
    n = len(cut) - 1
    values = np.full(n * size, EMPTY)
    owner = np.repeat(np.arange(n), np.diff(cut))
    order = None  # the permutations of the elements in play, from step 1 on
    low = np.uint64(0xFFFFFFFF)
    for step in range(size):
        draw = mix(members + np.uint64((step + 1) * int(GOLDEN) & 0xFFFFFFFFFFFFFFFF))
        pick = step + (((draw >> np.uint64(32)) * np.uint64(size - step)) >> np.uint64(32)).astype(np.int64)
        offer = (np.uint64(step) << np.uint64(32)) | (draw & low)
        if order is None:
            slot = pick
        else:
            rows = np.arange(len(members))
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, step]
        place = owner * size + slot
        free = values[place] > offer  # an earlier offer is less
        np.minimum.at(values, place[free], offer[free])
        open_sets = (values.reshape(n, size) == EMPTY).any(axis=1)
        if not open_sets.any():
            break
        going = open_sets[owner]
        if order is None:
            members, owner, pick = members[going], owner[going], pick[going]
            order = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint16), (len(members), 1))
            order[np.arange(len(members)), pick] = 0
        elif going.mean() < 0.8:
            members, owner, order = members[going], owner[going], order[going]
    return values.reshape(n, size)


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per set and band; keys of different bands differ."""
    parts = signatures.reshape(len(signatures), bands, -1)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, parts.shape[:2])
    for row in range(parts.shape[2]):
        keys = mix(keys * GOLDEN + parts[:, :, row])
    return keys.view(np.int64)


def sketches(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_key (null for an empty set) and bands (null for an empty set)."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column("text"))
            for a, b in runs(starts, RUN):
                part = data[starts[a] : starts[b]]
                members, cut = shingle_sets(part, starts[a : b + 1] - starts[a], width)
                keys = [
                    hashlib.blake2b(members[x:y].tobytes(), digest_size=16).digest() if y > x else None
                    for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)
                ]
                first: dict[bytes, int] = {}
                for at, key in enumerate(keys):
                    if key is not None:
                        first.setdefault(key, at)
                found: dict[bytes, np.ndarray] = {}
                if first:
                    chosen = np.array(list(first.values()))
                    sizes = cut[chosen + 1] - cut[chosen]
                    used = np.concatenate([members[cut[x] : cut[x + 1]] for x in chosen])
                    ends = np.concatenate([[0], np.cumsum(sizes)])
                    found = dict(zip(first, band_keys(superminhash(used, ends, bands * rows), bands), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(np.diff(cut)),
                        pa.array(keys, pa.binary()),
                        pa.array([found.get(key) for key in keys], pa.list_(pa.int64())),
                    ],
                    schema.fieldNames(),
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sketch, schema)


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """node and members (sorted, ``packed``) of the documents in ``ids`` and a few others.

    A bitmap of fixed size tells which texts to read again, so that none is shuffled;
    those it lets through by chance are dropped by the joins that follow.
    """
    slot = F.xxhash64("node").bitwiseAND((1 << BITS) - 1)
    marks = ids.select(F.shiftright(slot, 6).alias("word"), F.expr("shiftleft(1L, cast(xxhash64(node) & 63 as int))").alias("bit"))
    marks = marks.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bitmap = np.zeros(1 << (BITS - 6), np.int64)
    bitmap[marks["word"].to_numpy(np.int64)] = marks["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("members", T.BinaryType())])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            slots = np.asarray(batch.column("slot"))
            wanted = np.flatnonzero((bits[slots >> 6] >> (slots & 63)) & 1)
            if not len(wanted):
                continue
            batch = batch.take(pa.array(wanted))
            data, starts = utf8(batch.column("text"))
            for a, b in runs(starts, RUN):
                members, cut = shingle_sets(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a], width)
                sets = [packed(members[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(a, b - a), pa.array(sets, pa.binary())], schema.fieldNames()
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("node"), "text").where("node is not null")
    return rows.select("node", slot.alias("slot"), "text").mapInArrow(collect, schema)


def packed(members: np.ndarray) -> bytes:
    return members.astype("<u8").tobytes()


def unpacked(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), "<u8")


def alike(shared: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the similarity of sets of sizes a and b is at least ``percent``, in whole numbers."""
    return 100 * shared >= percent * (a + b - shared)


def block_links(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of alike sets, from the shingles that both sides share."""
    sizes = [np.array([len(x) for x in side], np.int64) for side in (left, right)]
    hashes = [np.concatenate(side) for side in (left, right)]
    owners = [np.repeat(np.arange(len(s)), s) for s in sizes]
    order = [np.argsort(h, kind="stable") for h in hashes]
    (x, y), (p, q) = ([h[o] for h, o in zip(hashes, order, strict=True)], [w[o] for w, o in zip(owners, order, strict=True)])
    low, high = np.searchsorted(y, x, "left"), np.searchsorted(y, x, "right")
    number = high - low
    shared = np.zeros(len(left) * len(right), np.int64)
    upto = np.concatenate([[0], np.cumsum(number)])
    a = 0
    while a < len(x):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + MATCHES, "right")) - 1)
        count = number[a:b]
        total = int(count.sum())
        if total:
            nth = np.arange(total) - np.repeat(upto[a:b] - upto[a], count)
            place = np.repeat(p[a:b], count) * len(right) + q[np.repeat(low[a:b], count) + nth]
            shared += np.bincount(place, minlength=len(shared))
        a = b
    shared = shared.reshape(len(left), len(right))
    return np.nonzero(alike(shared, sizes[0][:, None], sizes[1][None, :], percent))


def confirm_blocks(cells: DataFrame, percent: int) -> DataFrame:
    """Links between the two sides of each cell, as the forest that they form.

    Rows: bucket, chunk, part, side (0 or 1), node, members; a cell's rows follow
    each other.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, sides = None, ([], [])

        def out() -> pa.RecordBatch:
            u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if sides[0] and sides[1]:
                names = [np.array([node for node, _ in side], np.int64) for side in sides]
                i, j = block_links(*([x for _, x in side] for side in sides), percent)
                u, v = forest(names[0][i], names[1][j])
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            keys = zip(*(batch.column(name).to_pylist() for name in ("bucket", "chunk", "part")), strict=True)
            rows = zip(batch.column("side").to_pylist(), batch.column("node").to_pylist(), batch.column("members"), strict=True)
            for key, (side, node, members) in zip(keys, rows, strict=True):
                if key != cell:
                    if cell is not None:
                        yield out()
                    cell, sides = key, ([], [])
                sides[side].append((node, unpacked(members)))
        if cell is not None:
            yield out()

    return cells.mapInArrow(check, EDGE)


def by_bucket(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """``rows`` with the columns of their bucket's row in ``buckets`` (with ``size``), whatever its size.

    Buckets with more than 1 / SHARES of all rows go to every task, of which there are
    fewer than SHARES; so no task holds the rows of one bucket.
    """
    total = rows.count()
    large = buckets.where(F.col("size") * SHARES > total).withColumnRenamed("bucket", "of")
    small = buckets.where(F.col("size") * SHARES <= total).withColumnRenamed("bucket", "of")
    same = F.col("bucket") == F.col("of")
    if large.isEmpty():
        return rows.join(small, same).drop("of")
    names = large.select("of")
    first = rows.join(F.broadcast(large), same).drop("of")
    others = rows.join(F.broadcast(names), same, "left_anti")
    return first.unionByName(others.join(small, same).drop("of"))


def led(rows: DataFrame, order: Column) -> DataFrame:
    """Rows of buckets (bucket, band, node, n_shingles and others) with their bucket's leader, the last by ``order``.

    Added are ``head``, ``head_n`` and, if there are roots, ``head_root``, the bucket's ``size`` and ``weight``, and in how
    many ``chunks`` the members of a leader are compared with it.
    """
    chosen = ["node", "n_shingles", *[name for name in rows.columns if name == "root"]]
    heads = rows.groupBy("bucket").agg(
        F.max_by(F.struct(*chosen), order).alias("head"), F.count(F.lit(1)).alias("size"), F.sum(F.col("n_shingles") + ROW).alias("weight")
    )
    named = {"node": "head", "n_shingles": "head_n", "root": "head_root"}
    heads = stored(heads.where("size > 1").select("bucket", *[F.col(f"head.{name}").alias(named[name]) for name in chosen], "size", "weight"), "heads")
    # A leader leads at most one bucket a band.
    chunks = heads.groupBy(F.col("head").alias("of")).agg(F.ceil(F.sum("weight") / (8 * CELL)).cast("int").alias("chunks"))
    heads = heads.join(chunks, F.col("head") == F.col("of")).drop("of")
    return by_bucket(rows, heads)


def confirm_stars(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of members to leaders. A leader's set travels once for each chunk of its members."""
    near = F.least("n_shingles", "head_n") * 100 >= F.greatest("n_shingles", "head_n") * percent
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk")
    pairs = rows.where(near & (F.col("node") != F.col("head"))).select(F.col("head").alias("bucket"), chunk, "node").distinct()
    none = F.lit(0).alias("part")
    right = pairs.select("bucket", "chunk", none, F.lit(1).alias("side"), "node")
    left = pairs.select("bucket", "chunk").distinct().select("bucket", "chunk", none, F.lit(0).alias("side"), F.col("bucket").alias("node"))
    return confirm_blocks(with_sets(left.union(right), sets), percent)


def with_sets(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of cells with their sets, a cell's rows one after the other."""
    found = cells.join(sets.toDF("of", "members"), F.col("node") == F.col("of")).drop("of")
    return found.repartition("bucket", "chunk", "part").sortWithinPartitions("bucket", "chunk", "part", "side")


def open_rows(rows: DataFrame, roots: DataFrame, whole: bool = False) -> DataFrame:
    """The rows, with ``root``, of buckets that hold several components.

    With ``whole`` also ``size`` and ``weight`` of the bucket, the root ``top`` with most members, and
    how ``few`` members the others have.
    """
    found = rows.join(roots.toDF("__node", "__root"), F.col("node") == F.col("__node"), "left")
    found = found.withColumn("root", F.coalesce("__root", "node")).drop("__node", "__root")
    per_root = found.groupBy("bucket", "root").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("n_shingles") + ROW).cast("long").alias("weight")
    )
    mixed = per_root.groupBy("bucket").agg(
        F.max_by("root", F.struct("n", "root")).alias("top"), F.sum("n").alias("size"), F.sum("weight").alias("weight"),
        F.max("n").alias("most"),
    ).where("size > most").withColumn("few", F.col("size") - F.col("most")).drop("most")
    if not whole:
        mixed, found = mixed.select("bucket", "size"), found.drop("size")
    names = [name for name in found.columns if name not in ("size", "weight")]
    return by_bucket(found.select(*names), stored(mixed, "mixed"))


def block_cells(rows: DataFrame, percent: int, sets: DataFrame) -> DataFrame:
    """The members outside a bucket's largest component against all its members, in blocks."""
    few = rows.where("root <> top").groupBy("bucket")
    few = few.agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"), F.first("size").alias("size"))
    near = (F.col("n_shingles") * 100 >= F.col("least") * percent) & (F.col("n_shingles") * percent <= F.col("most") * 100)
    others = by_bucket(rows.drop("size"), stored(few, "few")).where(near)
    chunks = F.ceil(F.col("weight") / CELL).cast("int")
    parts = F.ceil(F.col("weight") * F.col("few") / F.col("size") / CELL).cast("int")
    chunk, part = F.pmod(F.xxhash64("node"), chunks), F.pmod(F.xxhash64("node"), parts)

    def every(n):
        return F.explode(F.sequence(F.lit(0), n - 1))

    right = others.select("bucket", chunk.cast("int").alias("chunk"), every(parts).alias("part"), F.lit(1).alias("side"), "node")
    left = rows.where("root <> top").select("bucket", every(chunks).alias("chunk"), part.cast("int").alias("part"), F.lit(0).alias("side"), "node")
    return with_sets(left.union(right), sets)


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 40, rows: int = 6
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Documents are linked if the similarity of their shingle sets is at least
    ``percent`` / 100. Null, empty and blank texts have an empty set and no links.
    Rows that share a doc_id are one document, which links through each of them; rows
    without a doc_id link with nothing, have no component and are kept. Other columns
    are not read.
    """
    base = stored(sketches(docs, width, bands, rows), "sketches")
    linked = base.where("set_key is not null and doc_id is not null")
    classes = linked.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    classes = stored(classes.withColumnRenamed("set_key", "of_key"), "classes")

    # One row per class and band. Most buckets hold one class, so only their keys are counted
    # before rows are left out; all that follows is small.
    stands = linked.join(classes, (F.col("set_key") == F.col("of_key")) & (F.col("doc_id") == F.col("node")))
    placed = stands.select("node", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    several = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = placed.join(several.select(F.col("bucket").alias("of")), F.col("bucket") == F.col("of"), "left_semi")
    met = stored(met, "met")
    sets = stored(full_sets(docs, met.select("node").distinct(), width), "sets")

    # Every member is compared with the one that meets others in most buckets: in a group of
    # copies of one text, that text.
    degree = met.groupBy(F.col("node").alias("of")).agg(F.count(F.lit(1)).alias("degree"))
    ranked = met.join(degree, F.col("node") == F.col("of")).drop("of")
    buckets = stored(led(ranked, F.struct(F.col("degree"), -F.col("node"))), "buckets")
    links = stored(confirm_stars(buckets, sets, percent), "stars")
    roots = components(links)

    # Then, in buckets that still hold several components, with others, each in some of the bands.
    order = F.xxhash64("node", F.col("band") % LEADERS)
    still = stored(open_rows(buckets.where("size > 2"), roots), "still")
    again = led(still.select("bucket", "band", "node", "n_shingles", "root"), order)
    more = stored(confirm_stars(again.where("root <> head_root"), sets, percent), "more-stars")
    roots = components(roots.toDF("u", "v").union(more))

    # Buckets that hold several components even so are compared in blocks.
    left = still.select("bucket", "band", "node", "n_shingles")
    rest = stored(open_rows(left, roots, whole=True), "open")
    blocks = stored(confirm_blocks(block_cells(rest, percent, sets), percent), "blocks")
    dropped(met, buckets, still, links, more)

    # Rows with one id and several sets are one document.
    mark = F.xxhash64("set_key")
    several = linked.groupBy("doc_id").agg(F.min(mark).alias("a"), F.max(mark).alias("b")).where("a <> b")
    own = linked.join(several.select(F.col("doc_id").alias("of")), F.col("doc_id") == F.col("of"))
    own = own.join(classes, F.col("set_key") == F.col("of_key")).select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    roots = components(roots.toDF("u", "v").union(blocks).union(own))
    dropped(rest, sets, blocks)

    found = base.select("doc_id", "n_shingles", "set_key")
    found = found.join(classes, F.col("set_key") == F.col("of_key"), "left")
    found = found.withColumn("own", F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id")))
    found = found.join(roots.toDF("of", "root"), F.col("own") == F.col("of"), "left")
    found = found.withColumn("component_id", F.coalesce("root", "own"))
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
