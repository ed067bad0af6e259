"""Merkle manifest of a dataset as a tree of SHA-256 midstates.

A parent's digest is the hash of its children's digests as hex text. Such a text has 64
bytes, which is one block of SHA-256; so the state of the hash before each child slot is
eight words, and a parent keeps a copy of it for each of its slots. To fold in a changed
child, hashing goes on from the state kept for its slot, with the replacement and the
siblings on its right; what stands on its left is not read again.

Trees are built bottom up in blocks of FAN ** LEVELS consecutive leaves: a block is one
row, its levels are hashed at once for all blocks of a batch, and the roots of blocks
are the leaves of the next round. The rounds a group needs grow with the logarithm of
its leaves, and no task holds more than some blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.llm.common import dropped, stored

FAN = 3
LEVELS = 8  # of a block, which has up to FAN ** LEVELS leaves
BLOCK = FAN**LEVELS
STEP = 2 + 32 + (FAN - 1) * 32  # bytes of one step of a path: slot, children, state, siblings
AT_ONCE = 1 << 13  # states that are hashed at once, so that they stay in the processor's cache


def _roots(number: int, power: int) -> list[int]:
    """The first 32 bits behind the point of the roots of the first primes."""
    primes = [p for p in range(2, 312) if all(p % q for q in range(2, int(p**0.5) + 1))][:number]
    found = []
    for p in primes:
        # The integer root of p * 2 ** (32 * power) has the 32 bits wanted as its low ones.
        low, high = 0, 1 << 40
        while low + 1 < high:
            middle = (low + high) // 2
            low, high = (middle, high) if middle**power <= p << (32 * power) else (low, middle)
        found.append(low & 0xFFFFFFFF)
    return found


START = np.array(_roots(8, 2), np.uint32)
ROUND = np.array(_roots(64, 3), np.uint32)
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def compressed(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states [n, 8] after one more block [n, 16] each."""
    found = np.empty_like(state)
    for a in range(0, len(state), AT_ONCE):
        found[a : a + AT_ONCE] = _compressed(state[a : a + AT_ONCE], block[a : a + AT_ONCE])
    return found


def _compressed(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = list(np.ascontiguousarray(block.T))
    a, b, c, d, e, f, g, h = before = np.ascontiguousarray(state.T)
    for t in range(64):
        if t >= 16:
            x, y = w[t - 15], w[t - 2]
            small = _turned(x, 7) ^ _turned(x, 18) ^ (x >> np.uint32(3))
            large = _turned(y, 17) ^ _turned(y, 19) ^ (y >> np.uint32(10))
            w.append(w[t - 16] + small + w[t - 7] + large)
        choice = g ^ (e & (f ^ g))
        first = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + choice + ROUND[t] + w[t]
        most = (a & b) | (c & (a | b))
        second = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + most
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return np.stack([x + y for x, y in zip(before, (a, b, c, d, e, f, g, h), strict=True)], axis=1)


def begun(n: int) -> np.ndarray:
    """The states of n hashes of nothing yet."""
    return np.tile(START, (n, 1))


def as_block(digest: np.ndarray) -> np.ndarray:
    """Digests [n, 32] as the blocks of their hex texts [n, 16]."""
    text = np.empty((len(digest), 64), np.uint8)
    text[:, 0::2], text[:, 1::2] = HEX[digest >> 4], HEX[digest & 15]
    return text.view(">u4").astype(np.uint32)


def closed(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests [n, 32] of hashes that have taken in so many whole blocks."""
    last = np.zeros((len(state), 16), np.uint32)
    last[:, 0] = 0x80000000
    bits = np.asarray(blocks, np.uint64) * np.uint64(512)
    last[:, 14], last[:, 15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return compressed(state, last).astype(">u4").view(np.uint8).reshape(-1, 32)


def taken(state: np.ndarray, digest: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The states after the digest's hex text, where ``which`` says so."""
    if which.all():
        return compressed(state, as_block(digest))
    found = state.copy()
    at = np.flatnonzero(which)
    found[at] = compressed(state[at], as_block(digest[at]))
    return found


@dataclass
class Levels:
    """The levels of many blocks, each level's nodes block after block."""

    nodes: list[np.ndarray]  # digests [nodes, 32] per level, leaves first
    starts: list[np.ndarray]  # where a block's nodes start, per level
    states: list[np.ndarray]  # of the parents of a level: state before each slot [parents, FAN, 8]

    @property
    def roots(self) -> np.ndarray:
        return self.nodes[-1]


def built(digests: np.ndarray, counts: np.ndarray, heights: np.ndarray) -> Levels:
    """Hash the leaves of many blocks, ``counts`` of each, up by ``heights`` levels each.

    A block whose height is reached keeps its one node; so the last level has the roots.
    """
    found = Levels([digests], [np.concatenate([[0], np.cumsum(counts)])], [])
    for level in range(int(heights.max(initial=0))):
        nodes, starts = found.nodes[-1], found.starts[-1]
        size = np.diff(starts)
        going = heights > level
        above = np.where(going, -(-size // FAN), size)
        upto = np.concatenate([[0], np.cumsum(above)])
        owner = np.repeat(np.arange(len(size)), above)
        nth = np.arange(upto[-1]) - upto[owner]
        open_ = going[owner]
        child = starts[owner] + np.where(open_, nth * FAN, nth)
        state = begun(len(child))
        kept = np.zeros((len(child), FAN, 8), np.uint32)
        number = np.where(open_, np.minimum(FAN, size[owner] - nth * FAN), 0)
        for slot in range(FAN):
            kept[:, slot] = state
            state = taken(state, nodes[np.minimum(child + slot, len(nodes) - 1)], number > slot)
        parent = nodes[child].copy()
        at = np.flatnonzero(open_)
        parent[at] = closed(state[at], number[at])
        found.nodes.append(parent)
        found.starts.append(upto)
        found.states.append(kept)
    return found


@dataclass
class Step:
    """One step up for many nodes: their slot, their parent's children and state before the slot, their siblings."""

    slot: np.ndarray
    children: np.ndarray  # 0: no step
    state: np.ndarray
    siblings: np.ndarray  # [nodes, FAN - 1, 32], from left to right

    def proven(self, state: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The proofs' states and number of blocks with this step's siblings."""
        for nth in range(FAN - 1):
            there = self.children > nth + 1
            state = taken(state, self.siblings[:, nth], there)
            blocks = blocks + there
        return state, blocks

    def folded(self, replacement: np.ndarray) -> np.ndarray:
        """The parents' digests with the nodes replaced, from the state before their slot on."""
        there = self.children > 0
        state = taken(self.state, replacement, there)
        for nth in range(FAN - 1):
            # Siblings from the node's slot on stand on its right.
            state = taken(state, self.siblings[:, nth], there & (nth >= self.slot) & (self.children > nth + 1))
        found = replacement.copy()
        at = np.flatnonzero(there)
        found[at] = closed(state[at], self.children[at])
        return found

    def packed(self) -> np.ndarray:
        """The steps as bytes [nodes, STEP]."""
        own = np.stack([self.slot, self.children], axis=1).astype(np.uint8)
        state = self.state.astype("<u4").view(np.uint8).reshape(-1, 32)
        return np.concatenate([own, state, self.siblings.reshape(-1, (FAN - 1) * 32)], axis=1)

    @classmethod
    def unpacked(cls, rows: np.ndarray) -> Step:
        state = np.ascontiguousarray(rows[:, 2:34]).view("<u4").astype(np.uint32)
        return cls(rows[:, 0].astype(int), rows[:, 1].astype(int), state, rows[:, 34:].reshape(-1, FAN - 1, 32))


def steps(levels: Levels, heights: np.ndarray) -> Iterator[Step]:
    """The steps of all leaves, level by level."""
    counts = np.diff(levels.starts[0])
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(owner)) - levels.starts[0][owner]
    for level, kept in enumerate(levels.states):
        nodes, starts = levels.nodes[level], levels.starts[level]
        going = heights[owner] > level
        slot = np.where(going, place % FAN, 0)
        above = np.where(going, place // FAN, place)
        size = np.diff(starts)[owner]
        children = np.where(going, np.minimum(FAN, size - above * FAN), 0)
        first = starts[owner] + above * FAN
        siblings = np.zeros((len(owner), FAN - 1, 32), np.uint8)
        for nth in range(FAN - 1):
            at = first + nth + (nth >= slot)
            there = children > nth + 1
            siblings[there, nth] = nodes[at[there]]
        yield Step(slot, children, kept[levels.starts[level + 1][owner] + above, slot], siblings)
        place = above


def height(leaves: np.ndarray) -> np.ndarray:
    """Levels above so many leaves until one node is left."""
    leaves, found = np.asarray(leaves).copy(), np.zeros(len(leaves), int)
    while (leaves > 1).any():
        found += leaves > 1
        leaves = -(-leaves // FAN)
    return found


def positions(rows: DataFrame, group: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """A stored table of ``rows`` with ``__at``, their place in their group from 0, and ``__of``, the group's rows.

    Rows are dealt by range, so a group of any size is spread over tasks; equal rows are
    dealt by where they come from. Only counts per task and group meet in one place.
    """
    names = [F.col(name) for name in group]
    keys = [*names, *order, F.monotonically_increasing_id()]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*names, *order)
    number = F.monotonically_increasing_id()
    dealt = dealt.withColumn("__task", F.shiftright(number, 33)).withColumn("__row", number.bitwiseAND((1 << 33) - 1))
    dealt = stored(dealt, "dealt")
    own = [F.col(name).alias(f"__g{k}") for k, name in enumerate(group)]
    counts = dealt.groupBy("__task", *own).agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    tasks = Window.partitionBy(*[f"__g{k}" for k in range(len(own))])
    before = F.sum("__n").over(tasks.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        F.col("__task").alias("__t"), *[f"__g{k}" for k in range(len(own))],
        (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__n").over(tasks).alias("__of"),
    )
    same = F.col("__task") == F.col("__t")
    for k, name in enumerate(group):
        same &= F.col(name).eqNullSafe(F.col(f"__g{k}"))
    found = dealt.join(counts, same).withColumn("__at", F.col("__row") + F.col("__shift"))
    return found.select(*rows.columns, "__at", "__of")


BLOCKS = "__count long, __of long, __nodes binary, __states binary, __root binary"


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    """The values of a binary column put together, as rows of ``width`` bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def blocks(leaves: DataFrame, group: Sequence[str], digest: str, payload: Sequence[str] = ()) -> DataFrame:
    """One row per block of a group's leaves: its digests, and its parents with their states.

    ``leaves`` has ``__at`` and ``__of``. The fixed columns: the group, ``__block``, ``__count`` leaves of
    ``__of`` in the group, ``__nodes`` (the digests of all levels, leaves first), ``__states`` (of
    all parents, the state before each slot) and ``__root``. Each payload column becomes
    the list of its values, in the order of the leaves.
    """
    rows = leaves.withColumn("__block", F.floor(F.col("__at") / BLOCK))
    fields = F.array_sort(F.collect_list(F.struct("__at", F.col(digest).alias("__digest"), *payload)))
    dealt = rows.groupBy(*group, "__block").agg(fields.alias("__leaves"), F.first("__of").alias("__of"))
    dealt = dealt.select(
        *group, "__block", F.size("__leaves").cast("long").alias("__count"), "__of",
        F.col("__leaves.__digest").alias("__digests"), *[F.col(f"__leaves.{name}").alias(name) for name in payload],
    )
    kept = [*group, "__block", *payload]
    schema = T.StructType([*[dealt.schema[name] for name in kept], *T._parse_datatype_string(BLOCKS).fields])

    def hash_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, of = (np.asarray(batch.column(name)) for name in ("__count", "__of"))
            digests = _bytes(batch.column("__digests").flatten(), 32)
            heights = own_heights(of)
            levels = built(digests, counts, heights)
            nodes, states, roots = [], [], []
            for k in range(len(counts)):
                high = int(heights[k])
                spans = [slice(s[k], s[k + 1]) for s in levels.starts[: high + 1]]
                nodes.append(b"".join(levels.nodes[i][span].tobytes() for i, span in enumerate(spans)))
                states.append(b"".join(levels.states[i][span].astype("<u4").tobytes() for i, span in enumerate(spans[1:])))
                roots.append(levels.roots[levels.starts[-1][k]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in kept], pa.array(counts), pa.array(of),
                 *[pa.array(x, pa.large_binary()).cast(pa.binary()) for x in (nodes, states, roots)]],
                schema.fieldNames(),
            )

    return dealt.mapInArrow(hash_up, schema)


def own_heights(of: np.ndarray) -> np.ndarray:
    """The levels of blocks whose groups have so many leaves: LEVELS where there are several blocks."""
    return np.minimum(height(of), LEVELS)


def opened(batch: pa.RecordBatch) -> tuple[Levels, np.ndarray]:
    """The levels that the rows of a table of blocks keep, and their heights."""
    counts, of = (np.asarray(batch.column(name)) for name in ("__count", "__of"))
    heights = own_heights(of)
    nodes = [np.frombuffer(x, np.uint8).reshape(-1, 32) for x in batch.column("__nodes").to_pylist()]
    states = [np.frombuffer(x, "<u4").astype(np.uint32).reshape(-1, FAN, 8) for x in batch.column("__states").to_pylist()]
    found = Levels([], [], [])
    size, node_at, state_at = counts, np.zeros(len(counts), int), np.zeros(len(counts), int)
    for level in range(int(heights.max(initial=0)) + 1):
        if level:
            going = heights >= level
            size = np.where(going, -(-size // FAN), size)
            empty = [np.zeros((int(s), FAN, 8), np.uint32) for s in size]
            part = [x[a : a + s] if g else e for x, a, s, g, e in zip(states, state_at, size, going, empty, strict=True)]
            found.states.append(np.concatenate(part))
            state_at = state_at + np.where(going, size, 0)
            node_at = np.where(going, node_at, node_at - size)  # the root stays
        found.nodes.append(np.concatenate([x[a : a + s] for x, a, s in zip(nodes, node_at, size, strict=True)]))
        found.starts.append(np.concatenate([[0], np.cumsum(size)]))
        node_at = node_at + size
    return found, heights


def root_paths(tree: DataFrame, group: Sequence[str]) -> DataFrame:
    """The group, ``__at`` and ``__path`` of every leaf of a table of blocks: its steps to the block's root, packed."""
    schema = T.StructType([
        *[tree.schema[name] for name in group], T.StructField("__block", T.LongType()), T.StructField("__at", T.LongType()),
        T.StructField("__path", T.BinaryType()),
    ])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels, heights = opened(batch)
            counts = np.diff(levels.starts[0])
            owner = np.repeat(np.arange(len(counts)), counts)
            packed = [step.packed() for step in steps(levels, heights)]
            table = np.stack(packed, axis=1) if packed else np.zeros((len(owner), 0, STEP), np.uint8)
            paths = [table[i, : heights[k]].tobytes() for i, k in enumerate(owner)]
            block = np.asarray(batch.column("__block"))[owner]
            at = block * BLOCK + np.arange(len(owner)) - levels.starts[0][owner]
            own = [batch.column(name).take(pa.array(owner)) for name in group]
            yield pa.RecordBatch.from_arrays([*own, pa.array(block), pa.array(at), pa.array(paths, pa.binary())], schema.fieldNames())

    columns = [*group, "__block", "__count", "__of", "__nodes", "__states"]
    return tree.select(*columns).mapInArrow(walk, schema)


def _equal(left: DataFrame, right: DataFrame, group: Sequence[str], *more: Column) -> Column:
    found = F.lit(True)
    for name in group:
        found &= left[name].eqNullSafe(right[name])
    for condition in more:
        found &= condition
    return found


def grown(leaves: DataFrame, group: Sequence[str], digest: str, payload: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The stored blocks of the leaves, and for each block its group's root and its path to it.

    The second table has the group, ``__block``, ``__root`` (of the group) and ``__path``. The blocks'
    roots are the leaves of the next round, until every group is one block.
    """
    tree = stored(blocks(leaves, group, digest, payload), "blocks")
    most = tree.agg(F.max("__of")).first()[0] or 0
    roots = tree.select(*group, F.col("__block").alias("__at"), F.ceil(F.col("__of") / BLOCK).alias("__of"), "__root")
    if most <= BLOCK:
        return tree, roots.select(*group, F.col("__at").alias("__block"), "__root", F.lit(b"").alias("__path"))
    above, further = grown(roots, group, "__root")
    paths = root_paths(above, group)
    further = further.select(*group, F.col("__block").alias("__b"), "__root", F.col("__path").alias("__rest"))
    found = paths.join(further, _equal(paths, further, group, F.col("__block") == F.col("__b")))
    path = F.concat("__path", "__rest")
    return tree, found.select(*[paths[name] for name in group], F.col("__at").alias("__block"), "__root", path.alias("__path"))


@dataclass
class Manifest:
    """A tree per group, and one tree over the roots of the groups in their order."""

    blocks: DataFrame  # of the groups' trees, with the states of all parents; see ``blocks``
    above: DataFrame  # group, __block, subroot, root, path from the block's root to the root
    group: list[str]
    payload: list[str]


def field(column: str) -> Column:
    """A value as it is hashed: ``-`` if null, else its bytes as UTF-8, counted."""
    text = F.col(column).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(columns: Sequence[str], replaced: dict[str, Column] | None = None) -> Column:
    """SHA-256 of the fields of a row, as 32 bytes."""
    parts = []
    for name in columns:
        if name in (replaced or {}):
            text = replaced[name]
            counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
            parts.append(F.when(text.isNull(), F.lit("-")).otherwise(counted))
        else:
            parts.append(field(name))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def build(rows: DataFrame, group: str, order: str, digest: str, payload: Sequence[str] = ()) -> Manifest:
    """The manifest of ``rows``: a tree per value of ``group`` (null is one), its leaves by ``order``, then by digest.

    A null order comes first. ``payload`` names the columns kept beside the leaves; the
    digest and the order are kept anyway. Rows with equal order and digest are alike, so
    it does not matter which of them comes first.
    """
    kept = list(dict.fromkeys([order, *payload]))
    placed = positions(rows.select(group, digest, *kept), [group], [order, digest])
    tree, own = grown(placed, [group], digest, kept)
    # The group's own root is the leaf of the tree over all groups.
    own = stored(own.withColumnRenamed("__root", "__subroot"), "own-paths")
    dropped(placed)
    tops = own.where("__block = 0").select(F.lit(0).alias("__all"), group, F.col("__subroot").alias("__leaf"))
    tops = positions(tops, ["__all"], [group])
    top_tree, top_own = grown(tops, ["__all"], "__leaf", [group])
    walked = root_paths(top_tree, ["__all"]).withColumnRenamed("__path", "__low")
    top_own = top_own.select(F.col("__block").alias("__b"), "__root", F.col("__path").alias("__high"))
    walked = walked.join(top_own, F.col("__block") == F.col("__b"))
    named = tops.select(F.col(group).alias("__name"), F.col("__at").alias("__place"))
    walked = walked.join(named, F.col("__at") == F.col("__place"))
    walked = walked.select("__name", "__root", F.concat("__low", "__high").alias("__top"))
    above = own.join(walked, F.col(group).eqNullSafe(F.col("__name")))
    above = above.select(group, "__block", "__subroot", "__root", F.concat("__path", "__top").alias("__path"))
    above = stored(above, "above")
    dropped(own, tops)
    return Manifest(tree, above, [group], kept)


def folded(manifest: Manifest, replacement: str) -> DataFrame:
    """For every leaf: the payload, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``replacement`` is the payload column with the digest that is folded in for the leaf,
    by the states and siblings kept, up to the root of all. Digests come as hex text;
    ``proof_sha256`` hashes the siblings on the way, level by level, from left to right.
    """
    tree, above, group = manifest.blocks, manifest.above, manifest.group
    names = [*group, *[n for n in manifest.payload if n not in group]]
    fields = [tree.schema[n] for n in group]
    fields += [T.StructField(n, tree.schema[n].dataType.elementType) for n in names if n not in group]
    texts = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = T.StructType([*fields, *[T.StructField(n, T.StringType()) for n in texts], T.StructField("verified", T.BooleanType())])

    def hexed(digests: np.ndarray) -> pa.Array:
        text = np.empty((len(digests), 64), np.uint8)
        text[:, 0::2], text[:, 1::2] = HEX[digests >> 4], HEX[digests & 15]
        ends = pa.array(np.arange(len(digests) + 1, dtype=np.int32) * 64)
        return pa.StringArray.from_buffers(len(digests), ends.buffers()[1], pa.py_buffer(text.tobytes()))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), 256):
                yield one(whole.slice(k, 256))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        levels, heights = opened(batch)
        counts = np.diff(levels.starts[0])
        owner = np.repeat(np.arange(len(counts)), counts)
        current = _bytes(batch.column(replacement).flatten(), 32)
        proof, number = begun(len(owner)), np.zeros(len(owner), int)
        for step in steps(levels, heights):
            proof, number = step.proven(proof, number)
            current = step.folded(current)
        paths = [np.frombuffer(x, np.uint8).reshape(-1, STEP) for x in batch.column("__path").to_pylist()]
        for nth in range(max(map(len, paths), default=0)):
            blank = np.zeros(STEP, np.uint8)
            rows = np.stack([p[nth] if nth < len(p) else blank for p in paths])
            step = Step.unpacked(rows[owner])
            proof, number = step.proven(proof, number)
            current = step.folded(current)
        subroot, root = (_bytes(batch.column(n), 32)[owner] for n in ("__subroot", "__root"))
        own = [batch.column(n).take(pa.array(owner)) if n in group else batch.column(n).flatten() for n in names]
        digests = [levels.nodes[0], subroot, root, closed(proof, number), current]
        verified = (current == root).all(axis=1)
        return pa.RecordBatch.from_arrays([*own, *map(hexed, digests), pa.array(verified)], schema.fieldNames())

    up = above.select(*[F.col(n).alias(f"__u{k}") for k, n in enumerate(group)], F.col("__block").alias("__b"), "__subroot", "__root", "__path")
    same = F.col("__block") == F.col("__b")
    for k, n in enumerate(group):
        same &= F.col(n).eqNullSafe(F.col(f"__u{k}"))
    joined = tree.drop("__root").join(up, same)
    kept = [*names, "__count", "__of", "__nodes", "__states", "__subroot", "__root", "__path"]
    return joined.select(*kept).mapInArrow(fold, schema)


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def documents_manifest(docs: DataFrame, tampered: Column, tampering: dict[str, Column]) -> Manifest:
    """The manifest of documents by source, beside each leaf the digest of its row after tampering.

    A row without an id comes first in its source; its id is hashed as null. Other columns
    are not read. An empty table has no trees.
    """
    leaf = row_digest(COLUMNS)
    other = F.when(tampered, row_digest(COLUMNS, tampering)).otherwise(leaf)
    rows = docs.select("source", "doc_id", leaf.alias("__digest"), other.alias("__replaced"))
    return build(rows, "source", "doc_id", "__digest", ["__replaced"])
