"""Run a builder over a stream, in as many steps as wanted, and close all its windows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from spindlewave.functions import durations
from spindlewave.session import settings

HEARTBEAT = "__heartbeat__"
# Far behind any reading, so that every window before it gets closed.
HEARTBEAT_TIME = "9999-01-01 00:00:00"

DELAY = timedelta(seconds=2)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def watermarked(
    readings: DataFrame, time: str = "event_time", delay: timedelta = DELAY
) -> DataFrame:
    """Readings with a watermark; call it after the sources have been united."""
    return readings.withWatermark(time, durations.text(delay))


def without_heartbeat(rows: DataFrame) -> DataFrame:
    """The rows of a ``Replay`` but for its heartbeat, whose time has reached the watermark all the same."""
    # As long as the condition is not deterministic, it stays above the watermark.
    return rows.where(F.when(F.spark_partition_id() >= 0, ~F.col("id").eqNullSafe(HEARTBEAT)))


class LateRows(StreamingQueryListener):
    """Sums the rows that the stateful operators of one query refuse as late.

    It hears of every micro-batch, however many there are. Spark refuses rows after
    partial aggregation, so a late reading counts once per window that is
    closed, and readings of one key and window that come in one batch count once.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.ended: dict[str, Event] = {}

    def started(self, run_id: str) -> None:
        self.ended.setdefault(run_id, Event())

    def onQueryStarted(self, event) -> None:
        self.started(str(event.runId))

    def onQueryProgress(self, event) -> None:
        run_id = str(event.progress.runId)
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.dropped[run_id] = self.dropped.get(run_id, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.started(str(event.runId))
        self.ended[str(event.runId)].set()

    def of(self, run_id: str, wait: float = 60.0) -> int:
        """The sum of an ended run; events arrive in order, its end last."""
        self.started(run_id)
        if not self.ended[run_id].wait(wait):
            raise TimeoutError(f"no end of the run {run_id} was heard of")
        return self.dropped.pop(run_id, 0)


class Replay:
    """A bounded stream of readings through ``build``, into a parquet table.

    ``advance`` processes what the source holds at the moment and stops; the
    next call goes on from the checkpoint. ``finish`` processes the rest and
    closes the windows that the watermark has not passed, by adding one
    heartbeat reading far in the future. The heartbeat has a source of its own,
    empty until then, and makes no reading of its own micro-batch late. A source
    limited to some files per trigger must be read with ``advance`` before. No
    sink sees the heartbeat, provided the result keeps the column ``id``.
    ``dropped`` sums what ``LateRows`` counts.

    ``sink`` configures the writer in place of the table, for instance with
    ``foreachBatch``. ``after`` is applied behind ``build``, without the heartbeat.
    """

    def __init__(
        self,
        readings: DataFrame,
        build: Callable[[DataFrame], DataFrame],
        work: str,
        time: str = "event_time",
        delay: timedelta = DELAY,
        sink: Callable[[DataFrame], DataStreamWriter] | None = None,
        output_mode: str = "append",
        state_partitions: int | None = None,
        after: Callable[[DataFrame], DataFrame] | None = None,
    ):
        self.spark: SparkSession = readings.sparkSession
        self.schema = readings.schema
        self.time = time
        self.heartbeats = f"{work}/heartbeat"
        self.checkpoint = f"{work}/checkpoint"
        self.out = f"{work}/out"
        self.output_mode = output_mode
        self.dropped = 0
        self._write_heartbeats(0)
        heartbeat = self.spark.readStream.schema(self.schema).parquet(self.heartbeats)
        self.state_partitions = state_partitions
        rows = build(watermarked(readings.unionByName(heartbeat), time, delay))
        if "id" in rows.columns:
            rows = without_heartbeat(rows)
        self.result_rows = after(rows) if after else rows
        self.sink = sink or self._table

    def _table(self, rows: DataFrame) -> DataStreamWriter:
        return rows.writeStream.format("parquet").option("path", self.out)

    def _write_heartbeats(self, count: int) -> None:
        values = {"id": F.lit(HEARTBEAT), self.time: F.lit(HEARTBEAT_TIME)}
        self.spark.range(0, count, 1, 1).select(
            *[
                values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
                for field in self.schema
            ]
        ).write.mode("append").parquet(self.heartbeats)

    def advance(self) -> Replay:
        late = LateRows()
        self.spark.streams.addListener(late)
        try:
            writer = self.sink(self.result_rows).outputMode(self.output_mode)
            query = start(writer, self.spark, self.checkpoint, True, self.state_partitions)
            query.awaitTermination()
            self.dropped += late.of(query.runId)
        finally:
            self.spark.streams.removeListener(late)
        return self

    def finish(self) -> Replay:
        self._write_heartbeats(1)
        return self.advance()

    def table(self) -> DataFrame:
        return self.spark.read.schema(self.result_rows.schema).parquet(self.out)


def start(
    writer: DataStreamWriter,
    spark: SparkSession,
    checkpoint: str,
    once: bool = False,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a query, with its state in RocksDB, outside the heap.

    ``once`` takes all available data and stops. The number of state partitions is
    fixed for the life of a checkpoint: it is ``spark.sql.shuffle.partitions``, or
    ``state_partitions`` if given.
    """
    options = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if state_partitions:
        options["spark.sql.shuffle.partitions"] = str(state_partitions)
    if once:
        writer = writer.trigger(availableNow=True)
    with settings(spark, options):
        return writer.option("checkpointLocation", checkpoint).start()


def as_batch(sink: Callable[[DataFrame, int], None], spark: SparkSession) -> Callable[[DataFrame, int], None]:
    """``sink`` for ``foreachBatch``, with the shuffle partitions of ``spark`` in place of the state's."""
    partitions = spark.conf.get("spark.sql.shuffle.partitions")

    def run(batch: DataFrame, batch_id: int) -> None:
        with settings(batch.sparkSession, {"spark.sql.shuffle.partitions": partitions}):
            sink(batch, batch_id)

    return run
