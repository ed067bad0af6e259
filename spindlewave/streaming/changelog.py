"""The pivoted features of a stream as a changelog: every change of a window's row, with its row kind.

Open windows are kept as sums per axis, with the row emitted last. When readings come in, that
row is taken back (``-U``) and the new one given (``+U``); the first row of a window is an insert
(``+I``). A window leaves the state when the watermark passes its end. The log only grows, so
any sink can take it, and folding it gives the table at any point.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from spindlewave.functions import durations
from spindlewave.schema import AXES, MEASURES

INSERT, BEFORE, AFTER = "+I", "-U", "+U"
KIND = "row_kind"


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums [axes, (n, mean, squares about it, least, most)] of two sets of values together."""
    n = a[:, 0] + b[:, 0]
    share = np.divide(b[:, 0], n, out=np.zeros(len(n)), where=n > 0)
    apart = b[:, 1] - a[:, 1]
    mean = a[:, 1] + apart * share
    squares = a[:, 2] + b[:, 2] + apart * apart * a[:, 0] * share
    return np.stack([n, mean, squares, np.minimum(a[:, 3], b[:, 3]), np.maximum(a[:, 4], b[:, 4])], axis=1)


def sums_of(axis: np.ndarray, value: np.ndarray, axes: int) -> np.ndarray:
    found = np.zeros((axes, 5))
    found[:, 3], found[:, 4] = np.inf, -np.inf
    for k in range(axes):
        own = value[(axis == k) & ~np.isnan(value)]
        if len(own):
            mean = own.mean()
            found[k] = len(own), mean, ((own - mean) ** 2).sum(), own.min(), own.max()
    return found


def measures(sums: np.ndarray) -> np.ndarray:
    """Average, deviation, variance and half the range of every axis, 0 of nothing, measure by measure."""
    n = sums[:, 0]
    some = n > 0
    variance = np.divide(sums[:, 2], n, out=np.zeros(len(n)), where=some)
    half = np.where(some, (sums[:, 4] - sums[:, 3]) / 2, 0.0)
    return np.concatenate([np.where(some, sums[:, 1], 0.0), np.sqrt(variance), variance, np.where(some, half, 0.0)])


class Changes(StatefulProcessor):
    """One window of one machine: its sums, its greatest state and the row emitted last."""

    STATE = T.StructType([
        T.StructField("sums", T.BinaryType()), T.StructField("state", T.StringType()), T.StructField("row", T.BinaryType()),
    ])

    def __init__(self, axes: int, width: int, features: Sequence[str]):
        self.axes, self.width, self.features = axes, width, list(features)

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("window", self.STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = self.kept.get() if self.kept.exists() else None
        if kept is None:
            self.handle.registerTimer((int(key[1]) + self.width) // 1000)
            sums, state = sums_of(np.zeros(0), np.zeros(0), self.axes), None
        else:
            sums, state = np.frombuffer(kept[0]).reshape(-1, 5), kept[1]
        for part in rows:
            value = np.where(part["x_there"].to_numpy(bool), part["x_v"].to_numpy(float), np.nan)
            sums = joined(sums, sums_of(part["x_axis"].to_numpy(int), value, self.axes))
            known = [s for s in part["x_state"].tolist() if s]
            state = max([*known, *([state] if state else [])], key=lambda s: s.encode(), default=None)
        row = measures(sums)
        found = [] if kept is None else [(BEFORE, np.frombuffer(kept[2]), kept[1])]
        found.append((INSERT if kept is None else AFTER, row, state))
        self.kept.update((sums.tobytes(), state, row.tobytes()))
        if kept is not None and kept[2] == row.tobytes() and kept[1] == state:
            return  # nothing has changed
        values = {name: [r[k] for _, r, _ in found] for k, name in enumerate(self.features)}
        yield pd.DataFrame({
            KIND: [kind for kind, _, _ in found], "id": [key[0]] * len(found), "x_start": [int(key[1])] * len(found), **values,
            "state": [s for _, _, s in found],
        })

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.kept.clear()
        return iter(())

    def close(self) -> None:
        pass


def changelog(
    readings: DataFrame,
    size: timedelta = timedelta(seconds=4),
    slide: timedelta = timedelta(seconds=2),
    axes: Sequence[str] = AXES,
    time: str = "event_time",
    value: str = "data",
    state: str = "state",
) -> DataFrame:
    """The rows of ``pivot_axes_fused`` on a watermarked stream as changes, with ``row_kind``.

    A reading is late for a window that the watermark has passed. Timers count milliseconds, so
    windows have to start and end on them. State has to be in RocksDB.
    """
    if durations.micros(size) % 1000 or durations.micros(slide) % 1000:
        raise ValueError("size and slide must be whole milliseconds")
    code = F.lit(-1)
    for k, axis in enumerate(axes):
        code = F.when(F.col("axis") == axis, F.lit(k)).otherwise(code)
    data = F.col(value).cast("double")
    hops = readings.select(
        "id", F.window(time, durations.text(size), durations.text(slide)).alias("window"), code.alias("x_axis"),
        F.coalesce(data, F.lit(0.0)).alias("x_v"), data.isNotNull().alias("x_there"), F.col(state).alias("x_state"),
    )
    # The time of the window carries the watermark, so that rows of open windows are kept.
    dealt = hops.select(
        "id", F.window_time("window").alias("x_time"), F.unix_micros("window.start").alias("x_start"), "x_axis", "x_v", "x_there", "x_state"
    )
    features = [f"{axis.lower()}_{measure}" for measure in MEASURES for axis in axes]
    out = T.StructType([
        T.StructField(KIND, T.StringType()), T.StructField("id", T.StringType()), T.StructField("x_start", T.LongType()),
        *[T.StructField(name, T.DoubleType()) for name in features], T.StructField("state", T.StringType()),
    ])
    changes = Changes(len(axes), durations.micros(size), features)
    found = dealt.groupBy("id", "x_start").transformWithStateInPandas(changes, out, "append", "EventTime")
    return found.select(KIND, "id", F.timestamp_micros("x_start").alias("rstart"), *features, "state")


def folded(log: DataFrame) -> DataFrame:
    """The table that a changelog leaves: what was given and not taken back."""
    rows = [name for name in log.columns if name != KIND]
    sign = F.when(F.col(KIND) == BEFORE, -1).otherwise(1)
    return log.groupBy(*rows).agg(F.sum(sign).alias("_left")).where("_left > 0").select(*rows)
