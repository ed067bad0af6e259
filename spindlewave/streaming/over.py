"""The trailing-range aggregate on a stream.

Spark has no range windows on streams. ``trailing_range`` keeps, per key and pane of one range, the
pane's readings and the sums per instant of the pane before, and emits the frames of a pane
when the watermark passes its end. So a reading is computed once. The state is one row per key and
block of ``PANES`` panes, with what is open of it: a call of Python and a state row cost far more than
a reading, and a pane may hold few.

``OverRangeSink`` is another way, for panes with very many readings: the stream only holds each
reading until the watermark has passed it (``settled``), spread over all tasks, and ``over_range``
computes the frames of a micro-batch as a batch, together with the last range of readings before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor

from spindlewave.functions import durations
from spindlewave.operators.over import over_range
from spindlewave.schema import KEYS
from spindlewave.streaming.replay import as_batch

CHUNK = 100_000

PANES = 64  # panes of a block at most, which share a state row and a timer

# Texts of times keep their microseconds.
TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class PaneFrames(StatefulProcessor):
    """State and timer of one key and block of panes.

    The state holds the readings of open panes (time, value, other columns as text), the sums per
    instant of panes that are closed but for the frames of the next one, and when the timer is due. A value
    that is null is 0 beside a mark.
    """

    STATE = T.StructType([
        *[T.StructField(name, T.BinaryType()) for name in ("t", "v", "there", "before")],
        T.StructField("rows", T.StringType()), T.StructField("due", T.LongType()),
    ])

    def __init__(self, width: int):
        self.width, self.panes = width, panes_of(width)

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", self.STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        t, v, there, before, texts, due = self._kept()
        start, new, sums = self._start(key), [(t, v, there)], [before]
        for part in rows:
            value = part["x_v"].to_numpy(float)
            known = part["x_there"].to_numpy(bool)
            at, own = part["x_at"].to_numpy(np.int64), part["x_own"].to_numpy(bool)
            new.append((at[own], value[own], known[own]))
            texts += part["x_row"][own].tolist()
            if not own.all():
                sums.append(sums_by_instant(at[~own] - start, value[~own], known[~own]))
        t, v, there = (np.concatenate(x) for x in zip(*new, strict=True))
        self._keep(start, t, v, there, by_instant(np.concatenate(sums)), texts, due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        t, v, there, before, texts, _ = self._kept()
        offset = t - self._start(key)
        pane = offset // self.width
        # Panes that end up to the watermark are complete.
        first_open = (timerValues.getCurrentWatermarkInMs() * 1000 - self._start(key)) // self.width
        order = np.argsort(pane, kind="stable")
        order = order[: np.searchsorted(pane[order], first_open)]
        framed, own, last = [], None, None
        for spot in np.split(order, np.flatnonzero(np.diff(pane[order])) + 1) if len(order) else []:
            number = int(pane[spot[0]])
            begin = number * self.width
            earlier = own if last == number - 1 else before[slice(*np.searchsorted(before[:, 0], [begin - self.width, begin]))]
            own, last = sums_by_instant(offset[spot], v[spot], there[spot]), number
            framed.append(frames_at(offset[spot] - begin, moved(own, -begin), moved(earlier, self.width - begin)))
        # Of what is closed only the last pane is a part of open frames, and these are the next block's after its end.
        before = before[np.searchsorted(before[:, 0], (first_open - 1) * self.width) :]
        if last == first_open - 1 and last < self.panes:
            before = own
        left = np.ones(len(t), bool)
        left[order] = False
        self._keep(self._start(key), t[left], v[left], there[left], before, [texts[k] for k in np.flatnonzero(left)])
        if framed:
            total, values, count = (np.concatenate(x) for x in zip(*framed, strict=True))
            average = np.where(values > 0, total / np.maximum(values, 1), np.nan)
            found = pd.DataFrame({"x_at": t[order], "x_row": [texts[k] for k in order], "x_avg": average, "x_count": count.astype(np.int64)})
            found["x_avg"] = found["x_avg"].astype(object).where(values > 0, None)
            yield found

    def _start(self, key) -> int:
        """The begin of the pane before the block: offsets from it are small numbers, so doubles hold them exactly."""
        return (int(key[-1]) * self.panes - 1) * self.width

    def _kept(self) -> tuple:
        kept = self.state.get() if self.state.exists() else None
        if kept is None:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool), np.zeros((0, 4)), [], None
        t, v, there = (np.frombuffer(x, kind) for x, kind in zip(kept[:3], (np.int64, np.float64, bool), strict=True))
        return t, v, there, np.frombuffer(kept[3]).reshape(-1, 4), kept[4].split("\n") if len(t) else [], kept[5]

    def _keep(self, start: int, t, v, there, before: np.ndarray, texts: list[str], due: int | None = None) -> None:
        """The state, with its timer at the end of the first pane that is still to be closed, or nothing."""
        ends = [(int(t.min()) - start) // self.width + 1] if len(t) else []
        # Sums are kept to the end of the pane after their own.
        ends += [int(before[0, 0]) // self.width + 2] if len(before) else []
        if not ends:
            self.state.clear()
            return
        # Due when no reading of the pane can come any more.
        end = -(-(start + min(ends) * self.width) // 1000)
        if due is None or end < due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(end)
            due = end
        self.state.update((t.tobytes(), v.tobytes(), there.tobytes(), before.tobytes(), "\n".join(texts), due))

    def close(self) -> None:
        pass


def panes_of(width: int) -> int:
    """The panes of a block: ``PANES``, as far as doubles hold the block's microseconds."""
    return max(1, min(PANES, 2**52 // width - 1))


def sums_by_instant(offset: np.ndarray, value: np.ndarray, there: np.ndarray) -> np.ndarray:
    """``by_instant`` of readings."""
    return by_instant(np.stack([offset.astype(float), np.where(there, value, 0.0), there.astype(float), np.ones(len(offset))], axis=1))


def by_instant(sums: np.ndarray) -> np.ndarray:
    """Rows (offset, sum, values, rows), one per offset, in order."""
    if not len(sums):
        return sums
    at, place = np.unique(sums[:, 0], return_inverse=True)
    return np.stack([at, *(np.bincount(place, sums[:, k]) for k in (1, 2, 3))], axis=1)


def pane_frames(offset: np.ndarray, value: np.ndarray, there: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum, values and rows of the frame that ends at each reading of a pane.

    That is what the pane holds up to the reading's instant, and what the pane before holds from the
    same offset on.
    """
    return frames_at(offset, sums_by_instant(offset, value, there), before)


def moved(sums: np.ndarray, by: int) -> np.ndarray:
    """Rows of ``by_instant`` with other offsets."""
    return sums + np.array([by, 0, 0, 0], float)


def frames_at(offset: np.ndarray, own: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``pane_frames`` at the offsets, from the sums per instant of the pane."""
    upto = np.cumsum(own[:, 1:], axis=0)
    since = np.concatenate([np.cumsum(before[::-1, 1:], axis=0)[::-1], np.zeros((1, 3))])
    spot = np.searchsorted(before[:, 0], own[:, 0], "left")
    frames = (upto + since[spot])[np.searchsorted(own[:, 0], offset)]
    return frames[:, 0], frames[:, 1], frames[:, 2]


def trailing_range(
    readings: DataFrame,
    preceding: timedelta = timedelta(seconds=2),
    keys: Sequence[str] = KEYS,
    time: str = "event_time",
    value: str = "data",
) -> DataFrame:
    """A watermarked stream with ``avg_data`` and ``count_`` over the range, once the watermark has passed a pane.

    A reading is a row of its own pane and, with its value alone, of the next one. Late readings are
    dropped. No watermark passes a reading without a time; it comes out at once with neither, since its frame is
    complete only when the stream has ended (``trailing_table`` adds it). State has to be in RocksDB.
    """
    width = durations.micros(preceding)
    panes = panes_of(width)
    timed = readings.where(F.col(time).isNotNull())
    at = F.unix_micros(time)
    pane = F.expr(f"(unix_micros(`{time}`) - pmod(unix_micros(`{time}`), {width})) div {width}")
    data = F.col(value).cast("double")
    others = [name for name in readings.columns if name not in (time, *keys)]
    row = F.to_json(F.struct(*others), {**TEXT, "ignoreNullFields": "false"})
    # The last pane of a block is a part of the frames of the next block's first one.
    copies = F.expr(f"""CASE WHEN pmod(_pane, {panes}) = {panes - 1}
        THEN array(named_struct('block', _block, 'own', true), named_struct('block', _block + 1, 'own', false))
        ELSE array(named_struct('block', _block, 'own', true)) END""")
    blocks = timed.withColumn("_pane", pane).withColumn("_block", F.expr(f"(_pane - pmod(_pane, {panes})) div {panes}"))
    # The column of times carries the watermark. Names that begin with a line do not reach Python.
    dealt = blocks.withColumn("_copy", F.explode(copies)).select(
        *keys, time, F.col("_copy.block").alias("x_block"), F.col("_copy.own").alias("x_own"), at.alias("x_at"),
        F.coalesce(data, F.lit(0.0)).alias("x_v"), data.isNotNull().alias("x_there"),
        F.when(F.col("_copy.own"), row).otherwise(F.lit("")).alias("x_row"),
    )
    fields = [T.StructField(f"x_k{k}", readings.schema[name].dataType) for k, name in enumerate(keys)]
    schema = T.StructType([T.StructField("x_at", T.LongType()), T.StructField("x_row", T.StringType()),
                           T.StructField("x_avg", T.DoubleType()), T.StructField("x_count", T.LongType())])
    out = T.StructType([*fields, *schema.fields])
    processor = KeyedPaneFrames(width, [f.name for f in fields])
    framed = dealt.groupBy(*keys, "x_block").transformWithStateInPandas(processor, out, "append", "EventTime")
    parsed = F.from_json("x_row", T.StructType([readings.schema[name] for name in others]), {**TEXT, "mode": "FAILFAST"})
    named = {name: F.col(f"x_k{k}") for k, name in enumerate(keys)} | {time: F.timestamp_micros("x_at")}
    found = framed.withColumn("_others", parsed).select(
        *[named.get(name, F.col(f"_others.`{name}`")).alias(name) for name in readings.columns],
        F.col("x_avg").alias("avg_data"), F.col("x_count").alias("count_"),
    )
    untimed = readings.where(F.col(time).isNull())
    empty = [F.lit(None).cast("double").alias("avg_data"), F.lit(None).cast("long").alias("count_")]
    return found.unionByName(untimed.select("*", *empty))


class KeyedPaneFrames(PaneFrames):
    """``PaneFrames`` with the key beside its frames."""

    def __init__(self, width: int, names: Sequence[str]):
        super().__init__(width)
        self.names = list(names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for found in super().handleExpiredTimer(key, timerValues, expiredTimerInfo):
            own = {name: [key[k]] * len(found) for k, name in enumerate(self.names)}
            yield pd.concat([pd.DataFrame(own, index=found.index, dtype=object), found], axis=1)


def trailing_table(
    written: DataFrame, preceding: timedelta = timedelta(seconds=2), time: str = "event_time", **options
) -> DataFrame:
    """What a finished ``trailing_range`` has written, with the frames of readings without a time."""
    untimed = written.where(F.col(time).isNull()).drop("avg_data", "count_")
    return written.where(F.col(time).isNotNull()).unionByName(over_range(untimed, preceding, time=time, **options))


def settled(readings: DataFrame, time: str = "event_time") -> DataFrame:
    """Each reading once the watermark has passed it, with its number of ``_copies``.

    Grouping by all columns spreads even a single machine axis over all tasks. No
    watermark passes a reading without a time; it comes out at once.
    """
    timed = readings.where(F.col(time).isNotNull())
    untimed = readings.where(F.col(time).isNull()).withColumn("_copies", F.lit(1).cast("long"))
    copies = timed.groupBy(*readings.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.unionByName(untimed)


def expand_copies(rows: DataFrame) -> DataFrame:
    """Each row as often as its ``_copies`` says.

    A row with very many copies is first cut into chunks that go to different
    tasks. The other rows stay where they are.
    """
    copies = F.col("_copies")

    def repeat(part: DataFrame) -> DataFrame:
        return part.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies.cast("int")))).drop(
            "_copy", "_copies"
        )

    starts = F.sequence(F.lit(0).cast("long"), copies - 1, F.lit(CHUNK).cast("long"))
    chunks = (
        rows.where(copies > CHUNK)
        .withColumn("_start", F.explode(starts))
        .withColumn("_copies", F.least(copies - F.col("_start"), F.lit(CHUNK).cast("long")))
        .repartition(F.xxhash64("_start", *rows.columns))
        .drop("_start")
    )
    return repeat(rows.where(copies <= CHUNK)).unionByName(repeat(chunks))


class OverRangeSink:
    """Writes the frames of settled readings to ``work/out``, one folder per batch.

    Every write replaces the folder of its batch, so a batch that is repeated
    after a failure leaves the same result. The settled readings and the tail
    for the next batch alternate between two folders. Readings without a time
    have one frame per key, which is complete when the stream has ended; they
    are kept apart and get it in ``table``.
    """

    def __init__(
        self,
        schema: T.StructType,
        work: str,
        preceding: timedelta = timedelta(seconds=2),
        keys: Sequence[str] = KEYS,
        time: str = "event_time",
        value: str = "data",
        panes: int = 1,
    ):
        self.schema = schema
        self.work = work
        self.preceding = preceding
        self.options = {"keys": tuple(keys), "time": time, "value": value, "panes": panes}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        time = self.options["time"]
        columns = self.schema.names

        # The batch is computed once, into the shared folder.
        folder = self._folder("settled", batch_id % 2)
        batch.write.mode("overwrite").parquet(folder)
        all_rows = expand_copies(spark.read.schema(batch.schema).parquet(folder))
        untimed = all_rows.where(F.col(time).isNull())
        self._replace(untimed.select(*columns), "untimed", batch_id)
        fresh = all_rows.where(F.col(time).isNotNull()).withColumn("_fresh", F.lit(True))
        rows = fresh
        if batch_id > 0:
            earlier = spark.read.schema(self.schema).parquet(self._folder("tail", (batch_id - 1) % 2))
            rows = rows.unionByName(earlier.withColumn("_fresh", F.lit(False)))

        newest = fresh.agg(F.max(F.unix_micros(time))).first()[0]
        if newest is None:
            tail, frames = rows, self._empty(spark)
        else:
            begin = F.timestamp_micros(F.lit(newest - durations.micros(self.preceding)))
            tail = rows.where(F.col(time) >= begin)
            frames = over_range(rows, self.preceding, **self.options).where("_fresh")
        self._replace(tail.select(*columns), "tail", batch_id % 2)
        self._replace(frames.select(*columns, "avg_data", "count_"), "out", batch_id)

    def _empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self._result_schema())

    def _replace(self, rows: DataFrame, kind: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(self._folder(kind, number))

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.work}/{kind}/batch_id={number}"

    def writer(self, rows: DataFrame) -> DataStreamWriter:
        return rows.writeStream.foreachBatch(as_batch(self, rows.sparkSession))

    def _result_schema(self) -> T.StructType:
        added = [T.StructField("avg_data", T.DoubleType()), T.StructField("count_", T.LongType())]
        return T.StructType([*self.schema.fields, *added])

    def table(self, spark: SparkSession) -> DataFrame:
        schema = self._result_schema().add("batch_id", T.LongType())
        timed = spark.read.schema(schema).parquet(f"{self.work}/out").drop("batch_id")
        kept = spark.read.schema(T.StructType([*self.schema.fields, schema["batch_id"]]))
        untimed = kept.parquet(f"{self.work}/untimed").drop("batch_id")
        return timed.unionByName(over_range(untimed, self.preceding, **self.options))
