from __future__ import annotations

import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from spindlewave.functions.states import code_text, text_code
from spindlewave.operators.pivot import pivot_axes_fused
from spindlewave.operators.windows import hopping_features, tumbling_features
from spindlewave.schema import FEATURE_SCHEMA, SIGNAL_FEATURES, STATE_DOMAIN
from tests.conftest import keyed, offset, reading_frame, same_rows

# (axis, window start) -> the twelve features, computed by hand.
EXPECTED = {
    ("X", -2): (-0.5, 3.5, 4.949747, 12.25, 24.5, 3.5, 2.5, 1.4, 4.3136, 0.714286, 1.0, 1.005155),
    ("X", 0): (
        1.0, 3.162278, 3.535534, 10.0, 12.5, 4.5, 1.48324, 3.033899, 40.454545, 0.494413, 1.5,
        1.601116,
    ),
    ("X", 2): (2.0, 2.44949, 3.0, 6.0, 9.0, 3.0, 1.825742, 1.643168, 19.26, 0.684653, 1.125,
               1.248548),
    ("Y", -2): (7.0, 0, None, 0, None, 0, 7.0, 0, 1.0, 1.0, 0, 0),
    ("Y", 0): (7.0, 0, None, 0, None, 0, 7.0, 0, 1.0, 1.0, 0, 0),
    ("VB", -2): (0, 0, 0, 0, 0, 0, 0, None, None, None, None, None),
    ("VB", 0): (0, 0, 0, 0, 0, 0, 0, None, None, None, None, None),
}


def test_golden_hop(golden):
    rows = hopping_features(golden, state="state").collect()
    found = {(r.axis, offset(r.wstart)): r for r in rows}
    assert set(found) == set(EXPECTED)
    for key, values in EXPECTED.items():
        for name, value in zip(SIGNAL_FEATURES, values):
            got = found[key][name]
            if value is None:
                assert got is None, (key, name)
            else:
                assert got == pytest.approx(value, abs=1e-6), (key, name)


def test_feature_row_schema(golden):
    fields = [(f.name, f.dataType) for f in hopping_features(golden, state="state").schema]
    assert fields == [(f.name, f.dataType) for f in FEATURE_SCHEMA]


def test_window_bounds_are_half_open(spark):
    rows = reading_frame(spark, [("1", "X", 1.0, 2.0, "0"), ("1", "X", 3.0, 4.0, "0")])
    found = {offset(r.wstart): r.avg_data for r in tumbling_features(rows).collect()}
    assert found == {2.0: 1.0, 4.0: 3.0}


def test_each_reading_is_in_two_hops(spark, golden):
    hops = hopping_features(golden.withColumn("data", F.lit(1.0)), features="textbook")
    assert hops.count() == 7
    counted = golden.groupBy(F.window("event_time", "4 seconds", "2 seconds"), "axis").count()
    assert counted.agg(F.sum("count")).first()[0] == 2 * golden.count()


def test_size_not_a_multiple_of_slide(golden):
    rows = hopping_features(golden, timedelta(seconds=3), timedelta(seconds=2), features="basic")
    found = {(r.axis, offset(r.wstart)): r.avg_data for r in rows.collect()}
    assert found[("X", -2)] == 3.0  # [-2, 1)
    assert found[("X", 0)] == pytest.approx(1.5)  # [0, 3): 3, -4, 2, 5
    assert found[("X", 2)] == pytest.approx(2.0)  # [2, 5): 2, 5, -1
    assert ("Y", -2) not in found


def test_negative_epoch(spark):
    rows = reading_frame(spark, [("1", "X", 5.0, -1_634_520_003.0, "0")])
    row = tumbling_features(rows).select(F.unix_micros("wstart").alias("t")).first()
    assert row.t == -4_000_000


def test_null_data_is_ignored_by_the_features(spark):
    rows = reading_frame(
        spark, [("1", "X", None, 0.0, "0"), ("1", "X", 4.0, 0.1, "1"), ("1", "X", 8.0, 0.2, None)]
    )
    row = tumbling_features(rows, features="signal", state="state").first()
    assert (row.avg_data, row.var_pop_data, row.rms, row.state) == (6.0, 4.0, 2.0, "1")


def test_all_null_window(spark):
    rows = reading_frame(spark, [("1", "X", None, 0.0, "0")])
    row = tumbling_features(rows, features="signal").first()
    assert all(row[name] is None for name in SIGNAL_FEATURES)


def test_textbook_features(spark):
    values = [3.0, -4.0, 1.0, 2.0]
    rows = reading_frame(spark, [("1", "X", v, i / 10, "0") for i, v in enumerate(values)])
    row = tumbling_features(rows, features="textbook").first()
    rms = math.sqrt(sum(v * v for v in values) / 4)
    mean_abs = sum(map(abs, values)) / 4
    assert row.true_rms == pytest.approx(rms)
    assert row.true_peak == 4.0
    assert row.crest_factor == pytest.approx(4 / rms)
    assert row.kurtosis_factor == pytest.approx(sum(v**4 for v in values) / 4 / rms**4)
    assert row.form_factor == pytest.approx(rms / mean_abs)
    assert row.pulse_factor == pytest.approx(4 / mean_abs)
    root = sum(math.sqrt(abs(v)) for v in values) / 4
    assert row.margin_factor == pytest.approx(4 / root**2)


def test_state_maximum_is_in_text_order(spark):
    rows = reading_frame(
        spark, [("1", "X", 1.0, i / 10, s) for i, s in enumerate(["accelerated", "new", "3"])]
    )
    plain = tumbling_features(rows, features="signal", state="state")
    coded = tumbling_features(rows, features="signal", state="state", state_domain=STATE_DOMAIN)
    assert plain.first().state == coded.first().state == "new"


def test_state_outside_the_domain_fails(spark):
    rows = reading_frame(spark, [("1", "X", 1.0, 0.0, "broken")])
    with pytest.raises(Exception, match="state outside its domain: broken"):
        tumbling_features(rows, state="state", state_domain=STATE_DOMAIN).collect()


def test_known_states_make_a_hash_aggregate(golden):
    coded = hopping_features(golden, state="state", state_domain=STATE_DOMAIN)
    plain = hopping_features(golden, state="state")
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan and "partial_" in plan
    # So do unknown ones, on their codes.
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "Join" not in plan


TEXTS = [None, "", "a", "B", "aa", "é", "😀x", "一二三四", "z" * 13, "z" * 14, "z" * 15, "z" * 14 + "é", "é" * 7, "é" * 8, "accelerated", "~"]


def test_codes_are_in_the_order_of_texts(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS if t], "t string")
    found = rows.select("t", text_code(F.col("t")).alias("c"), code_text(text_code(F.col("t"))).alias("back")).collect()
    for r in found:
        whole = len(r.t.encode()) <= 14
        assert r.back == (r.t if whole else None)
        for other in found:
            if r.t.encode()[:14] != other.t.encode()[:14] or whole != (len(other.t.encode()) <= 14):
                assert (r.c < other.c) == (r.t.encode() < other.t.encode())


@pytest.mark.parametrize("texts", [TEXTS, [t for t in TEXTS if t is None or len(t.encode()) <= 14]])
def test_greatest_text_of_a_window(spark, texts):
    rng = random.Random(3)
    rows = [(str(k % 3), "X", 1.0, rng.uniform(0, 30), rng.choice(texts)) for k in range(120)] + [("9", "X", 1.0, 5.0, None)]
    df = reading_frame(spark, rows)
    window = F.window("event_time", "4 seconds", "2 seconds")
    plain = df.groupBy("id", window).agg(F.max(F.nullif(F.col("state"), F.lit(""))).alias("s"))
    expected = {(r.id, r.window.start): r.s for r in plain.collect()}
    for by_slide in (False, True):
        found = hopping_features(df, state="state", by_slide=by_slide)
        assert {(r.id, r.wstart): r.state for r in found.collect()} == expected
    pivoted = pivot_axes_fused(df)
    assert {(r.id, r.rstart): r.state for r in pivoted.collect()} == expected


def test_layout_does_not_change_results(spark, golden):
    whole = hopping_features(golden.coalesce(1))
    split = hopping_features(golden.repartition(5))
    rounded = [
        df.select("axis", "wstart", *[F.round(n, 9).alias(n) for n in SIGNAL_FEATURES])
        for df in (whole, split)
    ]
    assert same_rows(*rounded)


def test_variance_relations(golden):
    for row in keyed(hopping_features(golden), "axis", "wstart").values():
        assert row.rms >= 0
        assert row.stddev_pop_data**2 == pytest.approx(row.var_pop_data)
        if row.var_samp_data is not None:
            assert row.var_pop_data <= row.var_samp_data


@pytest.mark.parametrize("size, slide", [(4, 2), (6, 2), (2, 2), (3, 2), (5, 3)])
def test_by_slide_equals_by_window(spark, size, slide):
    rng = random.Random(size)
    rows = [
        (str(rng.randint(1, 2)), rng.choice("XY"), rng.choice([None, 1e6 + rng.uniform(-1, 1), -3.0]),
         rng.uniform(-20, 20), rng.choice(["0", "2"]))
        for _ in range(400)
    ]
    df = reading_frame(spark, rows)
    options = {"size": timedelta(seconds=size), "slide": timedelta(seconds=slide), "state": "state"}
    plain, slides = (
        keyed(hopping_features(df, by_slide=b, **options), "id", "axis", "wstart") for b in (False, True)
    )
    assert plain.keys() == slides.keys()
    for key, row in plain.items():
        for name in (*SIGNAL_FEATURES, "state"):
            if isinstance(row[name], float):
                assert slides[key][name] == pytest.approx(row[name], rel=1e-9, abs=1e-6), name
            else:
                assert slides[key][name] == row[name]
    fused, by_slide = (
        keyed(pivot_axes_fused(df, options["size"], options["slide"], by_slide=b), "id", "rstart")
        for b in (False, True)
    )
    assert fused.keys() == by_slide.keys()
    for key, row in fused.items():
        assert by_slide[key].x_avg == pytest.approx(row.x_avg, rel=1e-9)
        assert by_slide[key].y_var == pytest.approx(row.y_var, rel=1e-9, abs=1e-6)


def test_by_slide_sums_each_reading_once(golden):
    plan = hopping_features(golden, by_slide=True)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("partial_") :]
    assert "Expand" not in below and "Generate" not in below
    # Panes of a second for windows of three seconds every two.
    plan = hopping_features(golden, timedelta(seconds=3), timedelta(seconds=2), by_slide=True)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan[plan.rindex("partial_") :]
