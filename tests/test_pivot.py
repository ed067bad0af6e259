from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from spindlewave.operators.pivot import pivot_axes, pivot_axes_fused
from spindlewave.operators.windows import hopping_features
from spindlewave.schema import PIVOT_FEATURES, PIVOT_SCHEMA, STATE_DOMAIN
from tests.conftest import offset, reading_frame, same_rows

EXPECTED = {
    -2.0: {"x_avg": -0.5, "y_avg": 7, "x_stddev": 3.5, "x_var": 12.25, "x_rms": 3.5},
    0.0: {"x_avg": 1.0, "y_avg": 7, "x_stddev": 3.162278, "x_var": 10.0, "x_rms": 4.5},
    2.0: {"x_avg": 2.0, "x_stddev": 2.44949, "x_var": 6.0, "x_rms": 3.0},
}


def cascade(df, **options):
    return pivot_axes(hopping_features(df, state="state", **options), **options)


def rounded(df):
    return df.select("id", "rstart", "state", *[F.round(n, 9).alias(n) for n in PIVOT_FEATURES])


@pytest.mark.parametrize("build", [cascade, pivot_axes_fused])
def test_golden_pivot(golden, build):
    found = {offset(r.rstart): r for r in build(golden).collect()}
    assert set(found) == set(EXPECTED)
    for start, values in EXPECTED.items():
        for name in PIVOT_FEATURES:
            assert found[start][name] == pytest.approx(values.get(name, 0), abs=1e-6), (start, name)


def test_schema(golden):
    expected = [(f.name, f.dataType) for f in PIVOT_SCHEMA]
    for df in (cascade(golden), pivot_axes_fused(golden)):
        assert [(f.name, f.dataType) for f in df.schema] == expected


def test_fused_equals_cascade(spark):
    rng = random.Random(3)
    rows = [
        (
            str(rng.randint(1, 4)),
            rng.choice(["X", "Y", "Z", "VB", "other"]),
            rng.uniform(-50, 50),
            rng.uniform(0, 60),
            rng.choice(STATE_DOMAIN),
        )
        for _ in range(2000)
    ]
    df = reading_frame(spark, rows)
    assert same_rows(rounded(cascade(df)), rounded(pivot_axes_fused(df)))
    coded = cascade(df, state_domain=STATE_DOMAIN)
    assert same_rows(rounded(coded), rounded(pivot_axes_fused(df, state_domain=STATE_DOMAIN)))


def test_axis_without_any_value(spark):
    df = reading_frame(spark, [("1", "X", None, 0.0, "0")])
    assert {r.x_avg for r in cascade(df).collect()} == {0.0}
    assert {r.x_avg for r in pivot_axes_fused(df).collect()} == {0.0}


def test_fused_form_has_one_shuffle(golden):
    plan = pivot_axes_fused(golden)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
