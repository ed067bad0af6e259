"""Token ids in files of entropy-coded blocks: static range asymmetric numeral systems.

One table of symbol frequencies is shared by all blocks. A block holds whole documents
and is coded by many interleaved states, one per lane: token i belongs to lane
i mod lanes. Blocks do not depend on each other. Within a block the states are noted
at checkpoints, so the decoder takes all stretches between checkpoints at once, each
with its own checksum.

Files are Parquet tables, since these are what every Spark store can hold: ``table``
has the frequencies, ``blocks`` one frame per block, in ascending order of doc_id by
(file_no, block_no), with the ids and lengths of its documents.

Frame, little-endian: magic, crc32 of the table, tokens, lanes, steps between
checkpoints, checkpoints, words; then per checkpoint crc32 of its tokens and place of
its first word, the states of all checkpoints (64 bits each), the words (32 bits each),
and crc32 of all that.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.llm import tokens
from spindlewave.llm.common import stored

MAGIC = b"SWRA"
HEADER = "<4sIIIIII"
SCALE = 20  # frequencies sum to 2 ** SCALE
LOW = np.uint64(1 << 31)  # states stay in [2 ** 31, 2 ** 63)
WORD = np.uint64(32)
LOW_WORD = np.uint64(0xFFFFFFFF)


class Damaged(ValueError):
    """A frame or its table does not agree with its checksum."""


def shared_frequencies(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Integer frequencies that sum to 2 ** scale, at least 1 for every symbol that occurs."""
    total, whole = int(counts.sum()), 1 << scale
    present = np.flatnonzero(counts)
    if len(present) > whole:
        raise ValueError(f"{len(present)} symbols do not fit in {whole} slots")
    found = np.zeros(len(counts), np.int64)
    if not total:
        return found
    exact = counts[present] / total * (whole - len(present))
    share = np.floor(exact).astype(np.int64)
    left = whole - len(present) - int(share.sum())
    share[np.argsort(share - exact, kind="stable")[:left]] += 1
    found[present] = 1 + share
    return found


class Coder:
    def __init__(self, frequencies: np.ndarray, lanes: int = 256, every: int = 128):
        self.frequency = frequencies.astype(np.uint64)
        self.below = np.concatenate([[0], np.cumsum(frequencies)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)
        self.crc = zlib.crc32(frequencies.astype("<u4").tobytes())
        self.lanes, self.every = lanes, every

    def encode(self, ids: np.ndarray) -> bytes:
        """A frame that holds the ids."""
        lanes, every, n = self.lanes, self.every, len(ids)
        frequency, below = self.frequency[ids], self.below[ids]
        limit = frequency << np.uint64(63 - SCALE)
        steps = -(-n // lanes)
        states = np.full(lanes, LOW)
        words: list[np.ndarray] = [np.zeros(0, "<u4")] * steps
        noted = []
        for step in range(steps - 1, -1, -1):
            a, b = step * lanes, min(n, (step + 1) * lanes)
            x = states[: b - a]
            full = x >= limit[a:b]
            words[step] = (x[full] & LOW_WORD).astype("<u4")
            x[full] >>= WORD
            quotient, rest = np.divmod(x, frequency[a:b])
            states[: b - a] = (quotient << np.uint64(SCALE)) + rest + below[a:b]
            if step % every == 0:
                noted.append(states.copy())
        starts = np.cumsum([0, *map(len, words)])[:-1][::every].astype("<u4")
        size = lanes * every
        crcs = [zlib.crc32(ids[a : a + size].astype("<u4").tobytes()) for a in range(0, n, size)]
        body = np.concatenate(words) if words else np.zeros(0, "<u4")
        frame = struct.pack(HEADER, MAGIC, self.crc, n, lanes, every, len(noted), len(body))
        frame += np.array(crcs, "<u4").tobytes() + starts.tobytes()
        frame += b"".join(x.astype("<u8").tobytes() for x in reversed(noted)) + body.tobytes()
        return frame + struct.pack("<I", zlib.crc32(frame))

    def decode(self, frame: bytes) -> np.ndarray:
        """The ids of a frame; all stretches between checkpoints are decoded side by side."""
        if len(frame) < struct.calcsize(HEADER) + 4 or zlib.crc32(frame[:-4]) != struct.unpack("<I", frame[-4:])[0]:
            raise Damaged("frame")
        magic, crc, n, lanes, every, points, size = struct.unpack_from(HEADER, frame)
        if magic != MAGIC or crc != self.crc:
            raise Damaged("table")
        at = struct.calcsize(HEADER)
        crcs = np.frombuffer(frame, "<u4", points, at)
        place = np.frombuffer(frame, "<u4", points, at + 4 * points).astype(np.int64)
        x = np.frombuffer(frame, "<u8", points * lanes, at + 8 * points).reshape(points, lanes)
        x = x.astype(np.uint64)
        words = np.frombuffer(frame, "<u4", size, at + 8 * points + 8 * points * lanes).astype(np.uint64)
        words = np.append(words, np.uint64(0))
        found = np.zeros((points, every, lanes), np.uint32)
        last = n - (points - 1) * every * lanes if points else 0
        low, lane = np.uint64((1 << SCALE) - 1), np.arange(lanes)
        for step in range(every if points > 1 else -(-last // lanes)):
            slot = x & low
            symbol = self.symbol[slot]
            y = self.frequency[symbol] * (x >> np.uint64(SCALE)) + slot - self.below[symbol]
            empty = y < LOW
            if (step + 1) * lanes > last:  # the last stretch has ended in some lanes
                over = step * lanes + lane >= last
                empty[-1] &= ~over
                y[-1] = np.where(over, x[-1], y[-1])
            upto = np.cumsum(empty, axis=1)
            read = (place[:, None] + upto - 1)[empty]
            y[empty] = (y[empty] << WORD) | words[read]
            place += upto[:, -1]
            x = y
            found[:, step] = symbol
        ids = found.reshape(-1)[:n]
        stretch = every * lanes
        for k in range(points):
            if zlib.crc32(ids[k * stretch : (k + 1) * stretch].astype("<u4").tobytes()) != crcs[k]:
                raise Damaged(f"stretch {k}")
        return ids


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Per document doc_id and its ids with the end mark; per task a row with symbol counts.

    Ids and counts are packed by ``packed``; a row has one of them, the other is null.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("ids", T.BinaryType()),
            T.StructField("counts", T.BinaryType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer)
        total = np.zeros(max(len(encoder.last), end_id + 1), np.int64)
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for first, found, places in encoder.encode(batch.column("text")):
                n = len(places) - 1
                total += np.bincount(found, minlength=len(total))
                total[end_id] += n
                ids = [np.append(found[a:b], found.dtype.type(end_id)) for a, b in zip(places[:-1], places[1:], strict=True)]
                columns = [batch.column("doc_id").slice(first, n), pa.array(map(packed, ids), pa.binary()), pa.nulls(n, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())
        if kind is not None:
            columns = [pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.array([packed(total)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte (first all low bytes, and so on), then Zstandard."""
    import zstandard

    size = numbers.dtype.itemsize
    data = b"".join((numbers >> (8 * k)).astype(np.uint8).tobytes() for k in range(size))
    return bytes([size]) + zstandard.ZstdCompressor(level=1).compress(data)


def unpacked(column: pa.Array) -> Iterator[np.ndarray]:
    import zstandard

    decompressor = zstandard.ZstdDecompressor()
    for value in column:
        data = memoryview(value.as_buffer())
        size = data[0]
        rows = np.frombuffer(decompressor.decompress(data[1:]), np.uint8).reshape(size, -1)
        found = rows[0].astype(f"<u{size}")
        for k in range(1, size):
            found |= rows[k].astype(found.dtype) << (8 * k)
        yield found


def count_symbols(ids: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; the vocabulary bounds what the driver gets."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for found in unpacked(batch.column("counts")):
                total = found.astype(np.int64) + (total if len(total) else 0)
        symbols = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(symbols), pa.array(total[symbols])], ["symbol", "n"])

    parts = ids.where("counts is not null").select("counts").mapInArrow(add, "symbol long, n long")
    rows = parts.groupBy("symbol").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(rows["symbol"].max()) + 1 if len(rows) else 1, np.int64)
    counts[rows["symbol"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts


def write_blocks(
    ids: DataFrame, path: str, *, block_tokens: int = 1 << 19, lanes: int = 1024, every: int = 256
) -> None:
    """Write the files. ``ids`` is a stored ``token_table``: it is read more than once.

    Documents are in ascending doc_id order (null first, repeated ids together, then by
    content); a block holds whole documents and is closed at ``block_tokens``.
    """
    spark = ids.sparkSession
    frequencies = shared_frequencies(count_symbols(ids))
    spark.createDataFrame(
        [(i, f) for i, f in enumerate(frequencies.tolist()) if f], "symbol long, frequency long"
    ).coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(frequencies)
    kind = ids.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("file_no", T.IntegerType()),
            T.StructField("block_no", T.IntegerType()),
            T.StructField("doc_ids", T.ArrayType(kind)),
            T.StructField("doc_tokens", T.ArrayType(T.LongType())),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("frame", T.BinaryType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value, lanes, every)
        file_no, block_no = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        names: list = []
        size = 0
        types = [pa.int32(), pa.int32(), None, pa.list_(pa.int64()), pa.int64(), pa.binary()]

        def block() -> pa.RecordBatch:
            lengths = [len(x) for x in held]
            row = [file_no, block_no, names, lengths, sum(lengths), coder.encode(np.concatenate(held))]
            arrays = [pa.array([value], t) for value, t in zip(row, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

        for batch in batches:
            types[2] = pa.list_(batch.schema.field("doc_id").type)
            for name, found in zip(batch.column("doc_id").to_pylist(), unpacked(batch.column("ids")), strict=True):
                names.append(name)
                held.append(found)
                size += len(found)
                if size >= block_tokens:
                    yield block()
                    held, names, size, block_no = [], [], 0, block_no + 1
        if held:
            yield block()

    ordered = ids.where("ids is not null").select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(encode, schema).write.option(
        "compression", "none"
    ).parquet(f"{path}/blocks")


def read_frequencies(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.parquet(f"{path}/table").toPandas()
    found = np.zeros(int(rows["symbol"].max()) + 1 if len(rows) else 1, np.int64)
    found[rows["symbol"].to_numpy(np.int64)] = rows["frequency"].to_numpy(np.int64)
    return found


def read_blocks(spark: SparkSession, path: str, *, ids: bool = True) -> DataFrame:
    """Decode the files: per document file_no, block_no, nth, doc_id, start, n_tokens, ids_crc32 and ids.

    ``start`` counts the ids of all documents before. A damaged frame, stretch or
    table fails the job.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    shared = spark.sparkContext.broadcast(read_frequencies(spark, path))
    # One row per file, then one window per file: no task sees all blocks.
    files = blocks.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = starts_before(Window.orderBy("file_no"), "n")
    files = files.select(F.col("file_no").alias("__file"), before.alias("__before"))
    within = starts_before(Window.partitionBy("file_no").orderBy("block_no"), "n_tokens")
    first = blocks.select(
        F.col("file_no").alias("__f"), F.col("block_no").alias("__b"), within.alias("__within")
    ).join(files, F.col("__f") == F.col("__file"))
    first = first.select("__f", "__b", (F.col("__within") + F.col("__before")).alias("first"))
    kind = blocks.schema["doc_ids"].dataType.elementType
    names = ["file_no", "block_no", "nth", "doc_id", "n_tokens", "ids_crc32"]
    types = [T.IntegerType(), T.IntegerType(), T.IntegerType(), kind, T.LongType(), T.LongType()]
    schema = T.StructType(
        [T.StructField(n, t) for n, t in zip(names, types, strict=True)]
        + [T.StructField("within", T.LongType())]
        + [T.StructField("ids", T.BinaryType())] * ids
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            for at in range(len(batch)):
                lengths = batch.column("doc_tokens")[at].values
                data = coder.decode(batch.column("frame")[at].as_py()).astype("<u4")
                ends = np.cumsum(np.asarray(lengths))
                if len(ends) and ends[-1] != len(data):
                    raise Damaged("lengths")
                parts = [x.tobytes() for x in np.split(data, ends[:-1])]
                n = len(parts)
                columns = [
                    pa.array([batch.column("file_no")[at].as_py()] * n, pa.int32()),
                    pa.array([batch.column("block_no")[at].as_py()] * n, pa.int32()),
                    pa.array(range(n), pa.int32()),
                    batch.column("doc_ids")[at].values,
                    lengths,
                    pa.array([zlib.crc32(x) for x in parts], pa.int64()),
                    pa.array(ends - np.asarray(lengths), pa.int64()),
                ] + [pa.array(parts, pa.binary())] * ids
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    found = blocks.select("file_no", "block_no", "doc_ids", "doc_tokens", "frame").mapInArrow(decode, schema)
    joined = found.join(first, (F.col("file_no") == F.col("__f")) & (F.col("block_no") == F.col("__b")))
    return joined.select(
        "file_no", "block_no", "nth", "doc_id", (F.col("first") + F.col("within")).alias("start"),
        *[name for name in ("n_tokens", "ids_crc32", "ids") if name in found.columns],
    )


def starts_before(window, column: str) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def encode_documents(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write all documents to ``path``; returns what was encoded (a stored table).

    Null and empty texts have the end mark alone; an empty table gives files without
    blocks; columns other than doc_id and text are not kept.
    """
    ids = stored(token_table(docs, tokenizer, end_id), "ids", compression="none")
    write_blocks(ids, path)
    return ids
