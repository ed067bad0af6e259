from __future__ import annotations

import random
from datetime import timedelta

from pyspark.sql import functions as F

from spindlewave.operators.over import over_range
from spindlewave.operators.pivot import pivot_axes, pivot_axes_fused
from spindlewave.operators.windows import hopping_features
from spindlewave.schema import PIVOT_FEATURES, READING_SCHEMA, SIGNAL_FEATURES, STATE_DOMAIN
from spindlewave.sinks.tables import BatchTable
from spindlewave.sources.readings import stream_parquet
from spindlewave.streaming.over import CHUNK, OverRangeSink, expand_copies, settled
from spindlewave.session import settings
from spindlewave.streaming.replay import ROCKSDB, Replay, as_batch
from tests.conftest import reading_frame, same_rows


def some_rows(seed, start, stop, n=300):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["1", "2"]),
            rng.choice(["X", "Y", "Z", "VB"]),
            float(rng.randint(-100, 100)),
            round(rng.uniform(start, stop), 3),
            rng.choice(STATE_DOMAIN),
        )
        for _ in range(n)
    ]


def features(df):
    return hopping_features(df, state="state", state_domain=STATE_DOMAIN)


def cascade(df):
    rows = hopping_features(df, state="state", keep_window=df.isStreaming)
    return pivot_axes(rows, state_domain=STATE_DOMAIN)


def rounded(df, names):
    return df.select(*[F.round(c, 9).alias(c) if c in names else c for c in df.columns])


class Source:
    """A folder that grows by one slice at a time."""

    def __init__(self, spark, folder):
        self.spark, self.path = spark, f"{folder}/readings"
        reading_frame(spark, []).write.parquet(self.path)
        self.stream = stream_parquet(spark, self.path, READING_SCHEMA)

    def add(self, rows):
        reading_frame(self.spark, rows).coalesce(2).write.mode("append").parquet(self.path)


def replayed(spark, tmp_path, build, slices, **options):
    source = Source(spark, tmp_path)
    replay = Replay(source.stream, build, str(tmp_path / "work"), **options)
    for rows in slices:
        source.add(rows)
        replay.advance()
    return replay.finish()


SLICES = [some_rows(1, 0, 10), some_rows(2, 10, 20), some_rows(3, 20, 30)]
ALL = [row for rows in SLICES for row in rows]


def test_hop_stream_equals_batch(spark, tmp_path):
    replay = replayed(spark, tmp_path, features, SLICES)
    batch = features(reading_frame(spark, ALL))
    assert same_rows(rounded(replay.table(), SIGNAL_FEATURES), rounded(batch, SIGNAL_FEATURES))
    assert replay.dropped == 0


def test_panes_on_a_stream_equal_a_batch(spark, tmp_path):
    def panes(df):
        return hopping_features(df, timedelta(seconds=3), timedelta(seconds=2), state="state", state_domain=STATE_DOMAIN, by_slide=True)

    replay = replayed(spark, tmp_path, panes, SLICES)
    batch = hopping_features(reading_frame(spark, ALL), timedelta(seconds=3), timedelta(seconds=2), state="state", state_domain=STATE_DOMAIN)
    assert same_rows(rounded(replay.table(), SIGNAL_FEATURES), rounded(batch, SIGNAL_FEATURES))


def test_new_run_goes_on_from_the_checkpoint(spark, tmp_path):
    source = Source(spark, tmp_path)
    for rows in SLICES:
        source.add(rows)
        replay = Replay(source.stream, features, str(tmp_path / "work")).advance()
    batch = features(reading_frame(spark, ALL))
    found = replay.finish().table()
    assert same_rows(rounded(found, SIGNAL_FEATURES), rounded(batch, SIGNAL_FEATURES))


def test_state_may_be_kept_in_rocksdb(spark, tmp_path):
    source = Source(spark, tmp_path)
    source.add(SLICES[0])
    key = "spark.sql.streaming.stateStore.providerClass"
    with settings(spark, {key: ROCKSDB}):
        replay = Replay(source.stream, pivot_axes_fused, str(tmp_path / "work")).finish()
    batch = pivot_axes_fused(reading_frame(spark, SLICES[0]))
    assert same_rows(rounded(replay.table(), PIVOT_FEATURES), rounded(batch, PIVOT_FEATURES))


def test_one_step_stream_equals_batch(spark, tmp_path):
    source = Source(spark, tmp_path)
    source.add(ALL)
    replay = Replay(source.stream, pivot_axes_fused, str(tmp_path / "work")).finish()
    batch = pivot_axes_fused(reading_frame(spark, ALL))
    assert same_rows(rounded(replay.table(), PIVOT_FEATURES), rounded(batch, PIVOT_FEATURES))


def test_cascade_stream_equals_fused_batch(spark, tmp_path):
    replay = replayed(spark, tmp_path, cascade, SLICES)
    batch = pivot_axes_fused(reading_frame(spark, ALL))
    assert same_rows(rounded(replay.table(), PIVOT_FEATURES), rounded(batch, PIVOT_FEATURES))


def test_open_windows_wait_for_the_watermark(spark, tmp_path):
    source = Source(spark, tmp_path)
    source.add([("1", "X", 1.0, 0.0, "0"), ("1", "X", 2.0, 9.0, "0")])
    replay = Replay(source.stream, features, str(tmp_path / "work")).advance()
    # Watermark 7 s: the windows from -2 and 0 are closed, those around 9 s are open.
    assert replay.table().count() == 2
    assert replay.finish().table().count() == 4


def test_late_reading_is_dropped_and_counted(spark, tmp_path):
    late = [("1", "X", 999.0, 1.0, "0")]
    replay = replayed(spark, tmp_path, features, [*SLICES[:2], SLICES[2] + late])
    batch = features(reading_frame(spark, ALL))
    assert same_rows(rounded(replay.table(), SIGNAL_FEATURES), rounded(batch, SIGNAL_FEATURES))
    assert replay.dropped == 2  # once per hopping window


def test_reading_within_the_delay_is_kept(spark, tmp_path):
    early = [("1", "X", 1.0, 10.0, "0")]
    behind = [("1", "X", 2.0, 8.5, "0")]
    replay = replayed(spark, tmp_path, features, [early, behind])
    assert same_rows(replay.table(), features(reading_frame(spark, early + behind)))


def test_update_mode_goes_through_a_batch_sink(spark, tmp_path):
    sink = BatchTable(str(tmp_path / "table"))
    replayed(
        spark, tmp_path, features, SLICES[:1],
        sink=lambda rows: rows.writeStream.foreachBatch(sink), output_mode="update",
    )
    batch = features(reading_frame(spark, SLICES[0])).select("id", "axis", "wstart")
    updates = sink.read(spark)
    assert updates.where("id = '__heartbeat__'").isEmpty()
    assert batch.exceptAll(updates.select("id", "axis", "wstart").distinct()).isEmpty()


def over_stream(spark, tmp_path, slices):
    source = Source(spark, tmp_path)
    sink = OverRangeSink(READING_SCHEMA, str(tmp_path / "work"))
    replay = Replay(source.stream, settled, str(tmp_path / "work"), sink=sink.writer)
    for rows in slices:
        source.add(rows)
        replay.advance()
    replay.finish()
    return sink


def test_over_stream_equals_batch(spark, tmp_path):
    twice = SLICES[1][0]
    late = ("1", "X", 999.0, 1.0, "0")
    slices = [SLICES[0], [*SLICES[1], twice, twice], [*SLICES[2], late]]
    sink = over_stream(spark, tmp_path, slices)
    batch = over_range(reading_frame(spark, [*ALL, twice, twice]))
    assert same_rows(rounded(sink.table(spark), ["avg_data"]), rounded(batch, ["avg_data"]))


def test_repeated_over_batch_leaves_the_same_result(spark, tmp_path):
    sink = OverRangeSink(READING_SCHEMA, str(tmp_path))
    first = settled(reading_frame(spark, SLICES[0]))
    second = settled(reading_frame(spark, SLICES[1]))
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        sink(batch, number)
    batch = over_range(reading_frame(spark, SLICES[0] + SLICES[1]))
    assert same_rows(rounded(sink.table(spark), ["avg_data"]), rounded(batch, ["avg_data"]))


def test_readings_without_a_time_are_as_in_a_batch(spark, tmp_path):
    untimed = [("1", "X", float(k), None, "0") for k in range(3)] + [("2", "Y", None, None, "1")]
    slices = [[*SLICES[0], *untimed[:2]], [*SLICES[1], *untimed[2:]], SLICES[2]]
    sink = over_stream(spark, tmp_path, slices)
    batch = over_range(reading_frame(spark, [*ALL, *untimed]))
    assert same_rows(rounded(sink.table(spark), ["avg_data"]), rounded(batch, ["avg_data"]))


def test_late_rows_are_counted_over_more_runs_than_are_remembered(spark, tmp_path):
    late = [("1", "X", 999.0, 1.0, "0")]
    with settings(spark, {"spark.sql.streaming.numRecentProgressUpdates": "1"}):
        replay = replayed(spark, tmp_path, features, [*SLICES, late, late])
    assert replay.dropped == 4


def test_sinks_keep_the_partitions_of_the_session(spark, tmp_path):
    seen = []

    def sink(batch, batch_id):
        batch.write.format("noop").mode("overwrite").save()
        seen.append(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    replayed(
        spark, tmp_path, features, SLICES[:1], state_partitions=2,
        sink=lambda rows: rows.writeStream.foreachBatch(as_batch(sink, spark)),
    )
    assert set(seen) == {partitions}


def test_expand_copies(spark):
    n = CHUNK * 2 + 5
    rows = spark.createDataFrame([("a", 1), ("b", 3), ("c", n)], "k string, _copies bigint")
    counted = {r.k: r["count"] for r in expand_copies(rows).groupBy("k").count().collect()}
    assert counted == {"a": 1, "b": 3, "c": n}


def test_hours_in_place_of_seconds(spark, tmp_path):
    hour = timedelta(hours=1)
    rows = [(i, a, d, t * 3600, s) for i, a, d, t, s in SLICES[0]]

    def build(df):
        return hopping_features(df, 4 * hour, 2 * hour)

    replay = replayed(spark, tmp_path, build, [rows], delay=2 * hour)
    batch = build(reading_frame(spark, rows))
    assert same_rows(rounded(replay.table(), SIGNAL_FEATURES), rounded(batch, SIGNAL_FEATURES))
