from __future__ import annotations

import random
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from spindlewave.functions import udaf
from spindlewave.operators import fold, over
from spindlewave.operators.fold import over_range_folded
from spindlewave.operators.over import instant_totals, over_range, over_range_merged, over_range_with
from tests.conftest import BASE_MILLIS, offset, reading_frame


def brute_force(rows, width=2.0):
    """(id, axis, data, offset) -> average and count of the frame."""
    results = []
    for i, axis, data, at, _ in rows:
        if at is None:
            frame = [r for r in rows if r[:2] == (i, axis) and r[3] is None]
        else:
            frame = [
                r
                for r in rows
                if r[:2] == (i, axis) and r[3] is not None
                and round(at * 1e6) - round(width * 1e6) <= round(r[3] * 1e6) <= round(at * 1e6)
            ]
        values = [r[2] for r in frame if r[2] is not None]
        mean = round(sum(values) / len(values), 6) + 0.0 if values else None
        results.append((i, axis, data, None if at is None else round(at * 1e6), mean, len(frame)))
    return Counter(results)


def collected(df):
    rows = df.select(
        "id", "axis", "data", (F.unix_micros("event_time") - BASE_MILLIS * 1000).alias("t"),
        (F.round("avg_data", 6) + 0.0).alias("a"), "count_",
    ).collect()
    return Counter(tuple(row) for row in rows)


def random_rows(seed, n=400, span=30.0, grain=0.05, nulls=True):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        at = round(rng.uniform(-span, span) / grain) * grain
        data = float(rng.randint(-1000, 1000)) / 8
        rows.append(
            (
                rng.choice(["1", "1", "1", "2"] + ([None] if nulls else [])),
                rng.choice(["X", "Y"]),
                None if nulls and rng.random() < 0.05 else data,
                None if nulls and rng.random() < 0.02 else round(at, 6),
                "0",
            )
        )
    return rows


def test_golden(golden):
    rows = over_range(golden).where("axis = 'X'").collect()
    found = {round(offset(r.event_time), 3): (r.avg_data, r.count_) for r in rows}
    expected = {0.5: (3.0, 1), 1.5: (-0.5, 2), 2.0: (1 / 3, 3), 2.5: (1.5, 4), 3.9: (2.0, 3)}
    assert set(found) == set(expected)
    for at, (mean, count) in expected.items():
        assert found[at] == (pytest.approx(mean), count)


@pytest.mark.parametrize("panes", [1, 4])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, panes):
    rows = random_rows(seed)
    assert collected(over_range(reading_frame(spark, rows), panes=panes)) == brute_force(rows)


def test_an_instant_with_a_third_of_all_rows(spark):
    rows = random_rows(5, n=200, nulls=False)
    rows += [("1", "X", float(i % 7), 3.0, "0") for i in range(100)]
    df = reading_frame(spark, rows)
    assert collected(over_range(df)) == brute_force(rows)
    # The hot instant is a single row in what the windows see.
    assert instant_totals(df).where(F.col("_rows") >= 100).count() == 1


def test_panes_must_divide_the_range(golden):
    with pytest.raises(ValueError):
        over_range(golden, timedelta(seconds=2), panes=3)


def test_frames_are_split_by_time(golden):
    plan = over_range(golden)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("pane" in line for line in windows)


def one_run(plan):
    return plan.count("Exchange "), plan.count("Scan "), plan.count("Join")


def test_ordinary_rows_go_through_one_exchange(spark, golden, tmp_path):
    golden.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    plan = over_range(rows)._jdf.queryExecution().executedPlan().toString()
    assert one_run(plan) == (1, 1, 0)
    plan = over_range_with(rows, {"count_": udaf.row_count()})
    assert one_run(plan._jdf.queryExecution().executedPlan().toString()) == (1, 1, 0)


def test_other_columns_and_duplicates_are_kept(spark):
    rows = [("1", "X", 1.0, 0.0, "a"), ("1", "X", 1.0, 0.0, "a"), ("1", "X", 4.0, 0.0, "b")]
    found = over_range(reading_frame(spark, rows)).collect()
    assert sorted(r.state for r in found) == ["a", "a", "b"]
    assert {(r.avg_data, r.count_) for r in found} == {(2.0, 3)}


def test_user_defined_count_equals_native(spark):
    rows = random_rows(7)
    df = reading_frame(spark, rows)
    counted = over_range_with(df, {"count_": udaf.row_count()})
    native = over_range(df).drop("avg_data")
    assert counted.exceptAll(native).isEmpty() and native.exceptAll(counted).isEmpty()


def test_user_defined_count_in_sql(spark):
    udaf.register(spark)
    rows = random_rows(8, n=60, nulls=False)
    df = reading_frame(spark, rows)
    df.createOrReplaceTempView("wear_data")
    found = spark.sql(
        """SELECT id, axis, event_time, data, avg(data) OVER w AS avg_data,
                  countUdaf(data) OVER w AS count_
           FROM wear_data
           WINDOW w AS (PARTITION BY id, axis ORDER BY event_time
                        RANGE BETWEEN INTERVAL '2' SECOND PRECEDING AND CURRENT ROW)"""
    )
    assert collected(found) == brute_force(rows)


def test_count_counts_nulls_too(spark):
    df = reading_frame(spark, [("1", "X", None, 0.0, "0"), ("1", "X", 1.0, 0.1, "0")])
    assert df.groupBy("id").agg(udaf.count_rows("data").alias("n")).first().n == 2


def test_grouped_count_in_two_steps(spark):
    df = reading_frame(spark, random_rows(9))
    counted = udaf.grouped_count(df, ("id", "axis"))
    native = df.groupBy("id", "axis").agg(F.count(F.lit(1)).alias("count_"))
    assert counted.exceptAll(native).isEmpty() and native.exceptAll(counted).isEmpty()


@pytest.mark.parametrize("distinct", [True, False])
def test_hot_instants_are_joined_in_parts(spark, monkeypatch, distinct):
    monkeypatch.setattr(over, "SHARES", 20)
    monkeypatch.setattr(over, "LEAST_SHARE", 5)
    rows = random_rows(12, n=200)
    rows += [("1", "X", float(i) if distinct else 1.0, 3.0, "0") for i in range(100)]
    rows += [(None, "Y", 2.0, None, "0")] * 50
    df = reading_frame(spark, rows).repartition(6)
    assert collected(over_range(df)) == brute_force(rows)
    merged = over_range_with(df, {"count_": udaf.row_count()})
    native = over_range(df).drop("avg_data")
    assert merged.exceptAll(native).isEmpty() and native.exceptAll(merged).isEmpty()


def test_results_are_not_broadcast(golden, monkeypatch):
    monkeypatch.setattr(over, "LEAST_SHARE", 3)
    plan = over_range(golden)._jdf.queryExecution().executedPlan().toString()
    # Only the lists of hot panes and instants are, which SHARES bounds.
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("BroadcastHashJoin") == plan.count("BroadcastExchange") == 5


def test_user_defined_mean_square(spark):
    rows = random_rows(13, nulls=True)
    df = reading_frame(spark, rows)
    found = over_range_with(df, {"square": udaf.mean_square(), "count_": udaf.row_count()})
    squares = reading_frame(spark, [(i, a, None if d is None else d * d, t, s) for i, a, d, t, s in rows])
    native = over_range(squares)
    left = found.select("id", "axis", "event_time", F.round(F.nanvl("square", F.lit(None)), 6).alias("s"), "count_")
    right = native.select("id", "axis", "event_time", F.round("avg_data", 6).alias("s"), "count_")
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("least", [2, 7, 30])
def test_hot_and_ordinary_panes_side_by_side(spark, monkeypatch, least):
    monkeypatch.setattr(over, "SHARES", 1000)
    monkeypatch.setattr(over, "LEAST_SHARE", least)
    rows = random_rows(14, n=300, span=20)
    assert collected(over_range(reading_frame(spark, rows), panes=2)) == brute_force(rows)


def frames_of(rows, width=2.0):
    """Each row with the rows of its frame in order of time."""
    for row in rows:
        i, axis, _, at, _ = row
        same = [r for r in rows if r[:2] == (i, axis) and (r[3] is None) == (at is None)]
        if at is not None:
            low, high = round(at * 1e6) - round(width * 1e6), round(at * 1e6)
            same = sorted((r for r in same if low <= round(r[3] * 1e6) <= high), key=lambda r: r[3])
        yield row, same


def merged_by_force(rows, width=2.0):
    results = []
    for (i, axis, data, at, _), frame in frames_of(rows, width):
        values = [r[2] for r in frame if r[2] is not None]
        kinds = {int(r[2]) % 5 for r in frame if r[2] is not None}
        instant = None if at is None else round(at * 1e6)
        results.append((i, axis, data, instant, max(values, default=None), min(values, default=None), sum(values), len(kinds)))
    return Counter(results)


def merged(df):
    kind = F.pmod(F.col("data").cast("int"), F.lit(5))
    merges = {
        "top": udaf.merged_max("data"), "low": udaf.merged_min("data"), "total": udaf.merged_sum("data"),
        "kinds": udaf.merged_distinct(kind, range(5)),
    }
    return merges


def plain(df, *names):
    at = (F.unix_micros("event_time") - BASE_MILLIS * 1000).alias("t")
    return Counter(tuple(r) for r in df.select("id", "axis", "data", at, *names).collect())


@pytest.mark.parametrize("hot, panes", [(False, 1), (True, 1), (True, 4)])
def test_merges_by_brute_force(spark, monkeypatch, hot, panes):
    if hot:
        monkeypatch.setattr(over, "SHARES", 40)
        monkeypatch.setattr(over, "LEAST_SHARE", 4)
    rows = random_rows(11)
    df = reading_frame(spark, rows).repartition(3)
    found = over_range_merged(df, merged(df), panes=panes)
    assert found.columns == [*df.columns, "top", "low", "total", "kinds"]
    assert plain(found, "top", "low", F.coalesce("total", F.lit(0.0)), "kinds") == merged_by_force(rows)


def test_merges_go_through_one_exchange(spark):
    df = reading_frame(spark, random_rows(3, 50))
    plan = over_range_merged(df, {"top": udaf.merged_max("data")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_folds_by_brute_force(spark, monkeypatch):
    rows = random_rows(12)
    # Instants are unique, so that the first value of a frame is certain.
    rows = [(i, axis, data, None if at is None else round(at + k * 1e-6, 6), s) for k, (i, axis, data, at, s) in enumerate(rows)]
    # One key column may be null, the other not.
    df = reading_frame(spark, rows).repartition(3).withColumn("axis", F.coalesce("axis", F.lit("X")))
    monkeypatch.setattr(over, "SHARES", 40)
    folds = {"top": udaf.folded_max(), "first": udaf.folded_first(), "kinds": udaf.folded_sketch()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")  # panes and instants go on from batch to batch
    try:
        found = over_range_folded(df, folds).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {}
    for row, frame in frames_of(rows):
        values = [r[2] for r in frame if r[2] is not None]
        expected.setdefault(row[:4], []).append((max(values, default=None), values[0] if values else None, len(set(values))))
    assert len(found) == len(rows)
    for r in found:
        at = None if r.event_time is None else round(offset(r.event_time), 6)
        top, first, kinds = expected[(r.id, r.axis, r.data, at)][0]
        assert r.top == top
        if at is not None:
            assert r.first == first
        assert abs(r.kinds - kinds) <= 0.5 + 0.35 * kinds


def test_folds_of_equal_instants(spark):
    rows = [("1", "X", float(k % 7), 1.0, "0") for k in range(300)] + [("1", "X", 50.0, -1.0, "0"), ("1", "X", 60.0, -1.001, "0")]
    df = reading_frame(spark, rows).repartition(4)
    found = over_range_folded(df, {"top": udaf.folded_max()})
    assert Counter((r.data, r.top) for r in found.collect()) == Counter(
        [(float(k % 7), 50.0) for k in range(300)] + [(50.0, 60.0), (60.0, 60.0)]
    )
    assert over_range_folded(df.limit(0), {"top": udaf.folded_max()}).count() == 0


def test_running_merges():
    import numpy as np

    random_ = np.random.default_rng(0)
    fresh = random_.random(200) < 0.1
    fresh[0] = True
    run, place = fold.places(fresh)
    states = random_.integers(0, 9, (200, 1)).astype(float)
    found = fold.running(states, place, lambda a, b: a + b)
    for k in range(200):
        assert found[k, 0] == states[(run == run[k]) & (np.arange(200) <= k)].sum()
    back = fold.places(np.append(True, run[::-1][1:] != run[::-1][:-1]))[1][::-1]
    found = fold.running(states, back, lambda a, b: a + b, backwards=True)
    for k in range(200):
        assert found[k, 0] == states[(run == run[k]) & (np.arange(200) >= k)].sum()
