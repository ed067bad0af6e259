"""Stateful operators of our own: trailing ranges, late readings, changelogs."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindlewave.operators.over import over_range
from spindlewave.operators.pivot import pivot_axes_fused
from spindlewave.schema import PIVOT_FEATURES, SIGNAL_FEATURES, STATE_DOMAIN
from spindlewave.session import settings
from spindlewave.streaming.changelog import KIND, changelog, folded, joined, measures, sums_of
from spindlewave.streaming.late import LateGate, lateness
from spindlewave.streaming.over import PANES, by_instant, pane_frames, panes_of, trailing_range, trailing_table
from spindlewave.streaming.replay import LateRows, Replay, without_heartbeat
from tests.conftest import reading_frame, same_rows
from tests.test_streaming import ALL, SLICES, Source, features, rounded


def stepped(spark, tmp_path, build, slices, **options):
    source = Source(spark, tmp_path)
    replay = Replay(source.stream, lambda df: build(without_heartbeat(df)), str(tmp_path / "work"), **options)
    progress = []
    for rows in slices:
        source.add(rows)
        replay.advance()
        progress.append(replay.table().count())
    return replay.finish(), progress


def test_trailing_range_equals_batch(spark, tmp_path):
    twice = SLICES[1][0]
    odd = [("1", "X", None, 14.2, None), ("1", "X", 5.0, 16.0, "0"), ("2", "Y", None, 17.999999, "0"), (None, "X", 1.0, 12.0, "a\"b\\\n")]
    untimed = [("1", "X", 7.0, None, "0"), ("1", "X", None, None, "0"), ("2", "Z", 3.0, None, None)]
    late = ("1", "X", 999.0, 1.0, "0")
    replay, progress = stepped(spark, tmp_path, trailing_range, [SLICES[0], [*SLICES[1], twice, twice, *odd, *untimed], [*SLICES[2], late]])
    expected = over_range(reading_frame(spark, [*ALL, twice, twice, *odd, *untimed]))
    found = trailing_table(replay.table())
    assert found.columns == expected.columns
    assert same_rows(rounded(found, ["avg_data"]), rounded(expected, ["avg_data"]))
    assert progress[0] < progress[1] < progress[2]  # panes come out as the watermark passes them


def test_state_of_a_trailing_range_is_bounded_by_panes(spark, tmp_path):
    source = Source(spark, tmp_path)
    replay = Replay(source.stream, lambda df: trailing_range(without_heartbeat(df)), str(tmp_path / "work"))
    seen = []
    source.add([("1", "X", float(k), 0.01 * k, "0") for k in range(1000)])

    def remember(writer):
        return writer.foreachBatch(lambda batch, number: seen.append(batch.count()))

    replay.sink = lambda rows: remember(rows.writeStream)
    from pyspark.sql.streaming import StreamingQueryListener

    totals = []

    class Listen(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            totals.extend(op.numRowsTotal for op in event.progress.stateOperators)

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            pass

    listener = Listen()
    spark.streams.addListener(listener)
    try:
        replay.advance()
    finally:
        spark.streams.removeListener(listener)
    # 1000 readings in ten seconds are five panes of one key, and the one behind.
    assert totals and max(totals) <= 6 * 3  # a pane has its state, its timer and the timer's index
    assert sum(seen) < 1000


def test_panes_share_state_and_calls_by_blocks(spark, tmp_path, monkeypatch):
    # A reading in most panes of 2 s, some with several, over five blocks and a far one; the steps meet within a pane.
    random = np.random.default_rng(3)
    offsets = [*np.sort(random.uniform(0, 600, 400)), 255.999999, 256.0, 256.0, 258.0, 258.000001, 5000.0]
    rows = [("1", "X", float(k), round(float(at), 6), "0") for k, at in enumerate(offsets)]
    behind = [("1", "Y", float(k), 300.0 - 0.25 * k, "0") for k in range(8)]
    rows.sort(key=lambda row: row[3])
    totals = []
    monkeypatch.setattr(LateRows, "onQueryProgress", lambda self, event: totals.extend(op.numRowsTotal for op in event.progress.stateOperators))
    source = Source(spark, tmp_path)
    replay = Replay(source.stream, lambda df: trailing_range(without_heartbeat(df)), str(tmp_path / "work"))
    for part in (rows[:150], [*rows[150:250], *behind], rows[250:]):
        source.add(part)
        replay.advance()
    found, expected = replay.finish().table(), over_range(reading_frame(spark, [*rows, *behind]))
    assert same_rows(rounded(found, ["avg_data"]), rounded(expected, ["avg_data"]))
    # Some 200 panes with readings lie in fewer than 12 blocks, each with its state, a timer and the timer's index.
    assert totals and max(totals) <= 12 * 3


def test_blocks_of_long_ranges_stay_exact():
    assert panes_of(2_000_000) == PANES and panes_of(86_400_000_000) == PANES
    for width in (2**47, 2**50, 2**52, 2**60):
        assert 1 <= panes_of(width) <= max(1, 2**52 // width)


def test_pane_frames_by_brute_force():
    random = np.random.default_rng(0)
    offset, old = random.integers(0, 50, 80), random.integers(0, 50, 60)
    value, there = random.integers(-5, 5, 80).astype(float), random.random(80) < 0.8
    earlier = np.stack([old.astype(float), random.integers(0, 9, 60).astype(float), np.ones(60), np.ones(60)], axis=1)
    total, values, count = pane_frames(offset, value, there, by_instant(earlier))
    for k in range(80):
        own, before = offset <= offset[k], old >= offset[k]
        assert total[k] == value[own & there].sum() + earlier[before, 1].sum()
        assert values[k] == (own & there).sum() + before.sum() and count[k] == own.sum() + before.sum()
    assert by_instant(np.zeros((0, 4))).shape == (0, 4)


def gate_of(spark, tmp_path, slices):
    source = Source(spark, tmp_path)
    gate = LateGate(source.stream, features, str(tmp_path / "work"), timedelta(seconds=4), timedelta(seconds=2))
    for rows in slices:
        source.add(rows)
        gate.advance()
    return gate.finish()


def test_late_readings_are_counted_and_returned(spark, tmp_path):
    # Three late readings of one key and window, which Spark would count as one row a window.
    late = [("1", "X", 999.0, 1.0, "0"), ("1", "X", 998.0, 1.0, "0"), ("1", "X", 998.0, 1.0, "0")]
    untimed = ("1", "X", 5.0, None, "0")
    gate = gate_of(spark, tmp_path, [*SLICES[:2], [*SLICES[2], *late, untimed]])
    found = gate.late()
    assert Counter((r.id, r.axis, r.data, r.windows, r.closed) for r in found.collect()) == Counter(
        [("1", "X", 999.0, 2, 2), ("1", "X", 998.0, 2, 2), ("1", "X", 998.0, 2, 2)]
    )
    batch = features(reading_frame(spark, ALL))
    assert same_rows(rounded(gate.table(), SIGNAL_FEATURES), rounded(batch, SIGNAL_FEATURES))
    assert gate.features.dropped == 0


def test_a_reading_late_for_one_window_counts_in_the_other(spark, tmp_path):
    # Watermark 7.5 s: of the windows of 5 s, that from 2 is closed, that from 4 is open.
    first, second = [("1", "X", 1.0, 9.5, "0")], [("1", "X", 2.0, 5.0, "0"), ("1", "X", 3.0, 3.9, "0")]
    gate = gate_of(spark, tmp_path, [first, second])
    assert {(r.data, r.windows, r.closed) for r in gate.late().collect()} == {(2.0, 2, 1), (3.0, 2, 2)}
    starts = {(r.wstart.second % 60, r.avg_data) for r in gate.table().collect()}
    assert starts == {(4, 2.0), (6, 1.0), (8, 1.0)}


def test_a_gate_runs_no_stream_on_nothing_and_no_empty_partitions(spark, tmp_path, monkeypatch):
    operators, runs = [], []
    monkeypatch.setattr(LateRows, "onQueryStarted", lambda self, event: runs.append(event.runId))
    monkeypatch.setattr(LateRows, "onQueryProgress", lambda self, event: operators.extend(event.progress.stateOperators))
    late = [("1", "X", 999.0, 1.0, "0")]
    with settings(spark, {"spark.sql.shuffle.partitions": "7"}):
        source = Source(spark, tmp_path)
        gate = LateGate(source.stream, features, str(tmp_path / "work"), timedelta(seconds=4), timedelta(seconds=2), buckets=3)
        assert not runs and gate.late().isEmpty()
        for rows in (SLICES[0], [*SLICES[1], *late]):
            source.add(rows)
            gate.advance()
    assert len(runs) == 4  # the gate and the features, twice
    assert {op.numShufflePartitions for op in operators} == {3, 7}
    assert [r.data for r in gate.late().collect()] == [999.0]


@pytest.mark.parametrize("size, slide", [(4, 2), (3, 2), (2, 2), (5, 1)])
def test_windows_of_a_reading(spark, tmp_path, size, slide):
    rows = [("1", "X", float(k), k * 0.7 - 3, "0") for k in range(30)]
    source = Source(spark, tmp_path)
    hop = (timedelta(seconds=size), timedelta(seconds=slide))
    replay = Replay(source.stream, lambda df: lateness(without_heartbeat(df), *hop), str(tmp_path / "work"))
    source.add(rows)
    found = replay.advance().table()
    counts = {r.data: r.windows for r in found.collect()}
    df = reading_frame(spark, rows)
    hops = df.select("data", F.window("event_time", f"{size} seconds", f"{slide} seconds")).groupBy("data").count()
    expected = {r["data"]: r["count"] for r in hops.collect()}
    assert {k: n for k, n in counts.items() if n} == expected and found.where("closed > 0").isEmpty()


def test_changelog_folds_to_the_batch(spark, tmp_path):
    rows = [*ALL, ("3", "Z", None, 4.0, None), ("3", "X", 5.0, 4.5, "2")]
    # Both halves of the readings meet in every window.
    slices = [rows[0::2], rows[1::2]]
    replay, _ = stepped(spark, tmp_path, changelog, slices, delay=timedelta(seconds=60))
    log = replay.table()
    batch = pivot_axes_fused(reading_frame(spark, rows), state_domain=STATE_DOMAIN)
    assert same_rows(rounded(folded(log), PIVOT_FEATURES), rounded(batch, PIVOT_FEATURES))
    kinds = Counter(r[KIND] for r in log.collect())
    assert kinds["+I"] == batch.count() and kinds["-U"] == kinds["+U"] > 0
    # What is taken back is what was given.
    given = log.where(f"{KIND} <> '-U'").drop(KIND)
    assert log.where(f"{KIND} = '-U'").drop(KIND).exceptAll(given).isEmpty()


def test_changelog_says_nothing_where_nothing_changes(spark, tmp_path):
    same = [("1", "X", 2.0, 1.0, "0")]
    replay, _ = stepped(spark, tmp_path, changelog, [same, [("1", "Q", 9.0, 1.0, "0")], same], delay=timedelta(seconds=60))
    log = replay.table()
    # An unknown axis adds nothing, an equal value neither: the average, spread and state stay.
    assert Counter(r[KIND] for r in log.collect()) == {"+I": 2}


def test_rows_late_for_a_window_do_not_reopen_it(spark, tmp_path):
    late = [("1", "X", 999.0, 1.0, "0")]
    replay, _ = stepped(spark, tmp_path, changelog, [*SLICES[:2], [*SLICES[2], *late]])
    batch = pivot_axes_fused(reading_frame(spark, ALL), state_domain=STATE_DOMAIN)
    assert same_rows(rounded(folded(replay.table()), PIVOT_FEATURES), rounded(batch, PIVOT_FEATURES))
    with pytest.raises(ValueError, match="milliseconds"):
        changelog(replay.table(), timedelta(microseconds=1500), timedelta(microseconds=500))


def test_sums_join(spark):
    random = np.random.default_rng(1)
    value, axis = random.normal(size=40), random.integers(0, 3, 40)
    whole = sums_of(axis, value, 4)
    parts = joined(sums_of(axis[:13], value[:13], 4), sums_of(axis[13:], value[13:], 4))
    assert np.allclose(whole[:3], parts[:3]) and parts[3, 0] == 0
    row = measures(parts)
    assert np.allclose(row[:3], [value[axis == k].mean() for k in range(3)]) and np.allclose(row[[3, 7, 11, 15]], 0)
    assert np.allclose(row[8:11], [value[axis == k].var() for k in range(3)])
