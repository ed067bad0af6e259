"""Best-fit packing of token pieces after Martello-Toth dominance reduction.

Pieces of one length are interchangeable, so the instance is the count of pieces per
length: at most ``capacity`` numbers, however many pieces there are. The plan is made
from these counts and says which ranks within a length go to which sequences; every
piece then finds its place by its rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.llm import tokens
from spindlewave.llm.common import stored

#: Pieces of one length ranked in one task, on average; a length with more is ranked in parts.
RANKED = 10_000

Bins = list[tuple[int, tuple[tuple[int, int], ...]]]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, ids: bool = True
) -> DataFrame:
    """Cut each document's ids, with the end mark, into pieces of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32 and, if asked for, ids (binary,
    little-endian unsigned 32-bit). A null or empty text has the end mark alone.
    Repeated rows and null ids give pieces like any other; other columns are dropped.
    """
    fields = [
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ] + [T.StructField("ids", T.BinaryType())] * ids
    end = np.array([end_id], "<u4")
    size = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for first, found, places in encoder.encode(batch.column("text")):
                rows, columns = [], [[], [], [], [], []]
                for at, (a, b) in enumerate(zip(places[:-1].tolist(), places[1:].tolist(), strict=True), first):
                    data = np.append(found[a:b].astype("<u4"), end).tobytes()
                    for piece, place in enumerate(range(0, len(data), size)):
                        part = data[place : place + size]
                        rows.append(at)
                        row = (piece, place // 4, len(part) // 4, zlib.crc32(part), part)
                        for column, value in zip(columns, row[: 4 + ids], strict=False):
                            column.append(value)
                arrays = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
                arrays += [pa.array(c, t) for c, t in zip(columns[: 4 + ids], kinds, strict=False)]
                yield pa.RecordBatch.from_arrays(arrays, names[: 5 + ids])

    return docs.select("doc_id", "text").mapInArrow(cut, T.StructType(fields))


def companions(counts: np.ndarray, length: int, capacity: int) -> tuple[int, ...] | None:
    """The lengths that, beside one piece of ``length``, dominate every other way to fill its bin.

    A set dominates when any feasible content of the bin can be exchanged for it, item
    by item, with items that are no longer. None if no set of up to three does provably.
    """
    room = capacity - length
    counts[length] -= 1
    try:
        there = np.flatnonzero(counts[: room + 1])
        if not len(there):
            return ()
        small = [int(x) for value in there[:3] for x in [value] * min(3, int(counts[value]))][:3]
        best = int(there[-1])
        if best == room or len(small) < 2 or small[0] + small[1] > room:
            return (best,)
        if len(small) == 3 and sum(small) <= room:
            return None
        # At most two more fit. The largest sum of two:
        places = np.searchsorted(there, np.minimum(room - there, there), "right") - 1
        same = (places >= 0) & (there[places] == there) & (counts[there] < 2)
        places = places - same
        sums = np.where(places >= 0, there + there[places], 0)
        if int(sums.max()) <= best:
            return (best,)
        counts[best] -= 1
        rest = np.flatnonzero(counts[: room - best + 1])
        counts[best] += 1
        if not len(rest):
            return None
        second = int(rest[-1])
        longer = there[there > second]
        two = [int(x) for value in longer[:2] for x in [value] * min(2, int(counts[value]))][:2]
        return (best, second) if len(two) < 2 or sum(two) > room else None
    finally:
        counts[length] += 1


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> Bins:
    """Fix dominating sets and take them out of ``counts``, until none is left."""
    fixed: Bins = []
    again = True
    while again:
        again = False
        for length in np.flatnonzero(counts)[::-1].tolist():
            while counts[length]:
                found = companions(counts, length, capacity)
                if found is None:
                    break
                need = Counter((length, *found))
                times = min(int(counts[x]) // k for x, k in need.items())
                for x, k in need.items():
                    counts[x] -= times * k
                fixed.append((times, tuple(need.items())))
                again = True
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> Bins:
    """Best fit, longest first; equal bins are handled together."""
    open_bins: dict[int, list] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, number: int, content: tuple) -> None:
        if not open_bins[room]:
            insort(rooms, room)
        open_bins[room].append((number, content))

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                number, content = open_bins[room].pop()
                if not open_bins[room]:
                    rooms.pop(at)
            else:
                room, content = capacity, ()
                number = -(-left // (capacity // length))
            each = room // length
            full = min(number, left // each)
            if full:
                put(room - full_length(each, length), full, (*content, (length, each)))
                left -= full * each
                number -= full
            if number and 0 < left < each:
                put(room - full_length(left, length), 1, (*content, (length, left)))
                left, number = 0, number - 1
            if number and content:
                put(room, number, content)
    return [bins for room in rooms for bins in open_bins[room]]


def full_length(number: int, length: int) -> int:
    return number * length


def plan(counts: np.ndarray, capacity: int) -> Bins:
    """(number of equal sequences, ((length, pieces of it), ...)) for all pieces."""
    counts = counts.copy()
    return reduce_by_dominance(counts, capacity) + best_fit(counts, capacity)


def places(bins: Bins) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, first sequence, pieces a sequence, offset), by rank."""
    found: dict[int, list] = defaultdict(list)
    ranks: Counter = Counter()
    sequence = 0
    for number, content in bins:
        offset = 0
        for length, each in content:
            found[length].append((ranks[length], sequence, each, offset))
            ranks[length] += number * each
            offset += length * each
        sequence += number
    return {length: np.array(rows, np.int64) for length, rows in found.items()}


def pack(pieces: DataFrame, keys: list[str], capacity: int = 4096) -> DataFrame:
    """Add sequence_id and offset to pieces with a column ``length``.

    ``keys`` name the rows for ranking; pieces that agree in them may change places.
    Lengths that are null, below 1 or above ``capacity`` are refused. Columns named
    sequence_id or offset are replaced. The rows should be a stored table: they are
    read twice. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    lengths = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).orderBy("length")
    counts = np.zeros(capacity + 1, np.int64)
    for row in lengths.toLocalIterator():
        if row["length"] is None or not 1 <= row["length"] <= capacity:
            raise ValueError(f"a piece of length {row['length']} for sequences of {capacity}")
        counts[row["length"]] = row["n"]
    shared = spark.sparkContext.broadcast(places(plan(counts, capacity)))

    parts = F.element_at(F.lit((counts // RANKED + 1).tolist()), F.col("length").cast("int") + 1)
    salted = pieces.withColumn("__part", F.pmod(F.xxhash64(*keys), parts))
    sizes = salted.groupBy("length", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("length").alias("__length"), F.col("__part").alias("__of"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
    )
    within = Window.partitionBy("length", "__part").orderBy(*keys)
    ranked = (
        salted.withColumn("__rank", F.row_number().over(within))
        .join(sizes, (F.col("length") == F.col("__length")) & (F.col("__part") == F.col("__of")))
        .withColumn("__rank", F.col("__rank") + F.col("__before") - 1)
        .select(*names, "__rank")
    )
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            lengths = np.asarray(batch.column("length")).astype(np.int64)
            ranks = np.asarray(batch.column("__rank")).astype(np.int64)
            sequences, offsets = np.zeros_like(ranks), np.zeros_like(ranks)
            for length in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == length)
                rows = found[length]
                first, sequence, each, offset = rows[
                    np.searchsorted(rows[:, 0], ranks[mine], "right") - 1
                ].T
                nth, place = np.divmod(ranks[mine] - first, each)
                sequences[mine] = sequence + nth
                offsets[mine] = offset + place * length
            columns = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequences), pa.array(offsets)], [*names, "sequence_id", "offset"]
            )

    return ranked.mapInArrow(locate, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece with its place: see ``token_pieces`` and ``pack``."""
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id, ids=False), "pieces")
    return pack(pieces, ["doc_id", "piece", "ids_crc32"], capacity)
