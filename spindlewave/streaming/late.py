"""Late readings, one by one.

Spark refuses late rows behind partial aggregation, so its own count is of window rows, and
what was refused is gone. ``lateness`` tests every reading against the watermark of its
micro-batch before anything is aggregated, and says how many of its windows are closed.
``LateGate`` runs it as a stream of its own: the readings that still count go on to a table that the
features are streamed from, the others to a table of late readings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from spindlewave.functions import durations
from spindlewave.session import make_folder
from spindlewave.streaming.over import TEXT
from spindlewave.streaming.replay import DELAY, Replay, without_heartbeat

BUCKETS = 64  # groups that readings are dealt to; the test itself needs no key


def lateness(
    readings: DataFrame,
    size: timedelta = timedelta(seconds=4),
    slide: timedelta = timedelta(seconds=2),
    time: str = "event_time",
    buckets: int = BUCKETS,
) -> DataFrame:
    """A watermarked stream with ``windows``, the number of hopping windows of a reading, and ``closed``, how many
    of them end at or before the watermark of the micro-batch.

    A reading without a time belongs to no window and is never late. Nothing is kept in the state.
    """
    width, step = durations.micros(size), durations.micros(slide)

    def test(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs() * 1000
        for part in parts:
            at = part["x_at"]
            # Windows start at the multiples of the slide in (t - size, t].
            last = at // step
            first = (at - width) // step + 1
            # Those that start at or before mark - size are closed.
            shut = ((mark - width) // step if mark > 0 else -(2**62) // step) - first + 1
            windows = last - first + 1
            yield pd.DataFrame({"x_at": at, "x_row": part["x_row"], "windows": windows, "closed": shut.clip(0, windows)})

    others = [name for name in readings.columns if name != time]
    row = F.to_json(F.struct(*others), {**TEXT, "ignoreNullFields": "false"})
    timed = readings.where(F.col(time).isNotNull()).select(
        time, F.unix_micros(time).alias("x_at"), row.alias("x_row"), F.pmod(F.xxhash64(time, *others), F.lit(buckets)).alias("x_bucket")
    )
    out = "x_at long, x_row string, windows long, closed long"
    tested = timed.groupBy("x_bucket").applyInPandasWithState(test, out, "x long", "append", GroupStateTimeout.NoTimeout)
    parsed = F.from_json("x_row", T.StructType([readings.schema[name] for name in others]), {**TEXT, "mode": "FAILFAST"})
    named = {time: F.timestamp_micros("x_at")}
    found = tested.withColumn("x_others", parsed).select(
        *[named.get(name, F.col(f"x_others.`{name}`")).alias(name) for name in readings.columns], "windows", "closed"
    )
    zero = F.lit(0).cast("long")
    return found.unionByName(readings.where(F.col(time).isNull()).select("*", zero.alias("windows"), zero.alias("closed")))


class LateGate:
    """A ``Replay`` of features behind a gate that sorts out late readings.

    A step first passes the new readings through the gate, then the ones that count through the
    features. Late readings never move a watermark, so both streams have the same one.

    The gate keeps nothing in its state, so it gets no more state partitions than its ``buckets``: others
    would have no reading and cost as much in every micro-batch.
    """

    def __init__(
        self,
        readings: DataFrame,
        build: Callable[[DataFrame], DataFrame],
        work: str,
        size: timedelta,
        slide: timedelta,
        time: str = "event_time",
        delay: timedelta = DELAY,
        buckets: int = BUCKETS,
        **options,
    ):
        self.spark = readings.sparkSession
        self.schema = readings.schema
        partitions = options.get("state_partitions") or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.gate = Replay(
            readings, lambda rows: lateness(without_heartbeat(rows), size, slide, time, buckets), f"{work}/gate", time, delay,
            **{**options, "state_partitions": min(buckets, partitions)},
        )
        # The gate's table has to be there before it is read as a stream.
        make_folder(self.spark, self.gate.out)
        passed = self.spark.readStream.schema(self.gate.result_rows.schema).parquet(self.gate.out)
        kept = passed.where("windows = 0 or closed < windows").select(*self.schema.names)
        self.features = Replay(kept, build, f"{work}/features", time, delay, **options)

    def advance(self) -> LateGate:
        self.gate.advance()
        self.features.advance()
        return self

    def finish(self) -> LateGate:
        # A heartbeat passes no gate: each of the streams has its own.
        self.gate.advance()
        self.features.finish()
        return self

    def table(self) -> DataFrame:
        return self.features.table()

    def late(self) -> DataFrame:
        """The readings that were late for at least one of their windows, with ``windows`` and ``closed``."""
        return self.gate.table().where("closed > 0")
