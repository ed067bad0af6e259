from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from spindlewave.schema import READING_SCHEMA
from spindlewave.session import build_session

BASE_MILLIS = 1_634_520_000_000  # 2021-10-18 01:20:00 UTC

# Axis -> offset in seconds -> value; axis Z is missing.
GOLDEN = {
    "X": {0.5: 3.0, 1.5: -4.0, 2.0: 2.0, 2.5: 5.0, 3.9: -1.0},
    "Y": {1.0: 7.0},
    "VB": {0.0: 0.0, 0.1: 0.0},
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def reading_frame(spark, rows):
    """Readings from (id, axis, data, offset in seconds or None, state)."""
    from pyspark.sql import functions as F

    raw = spark.createDataFrame(
        [
            (i, axis, data, None if at is None else BASE_MILLIS * 1000 + round(at * 1e6), state)
            for i, axis, data, at, state in rows
        ],
        "id string, axis string, data double, t bigint, state string",
    )
    return raw.select(
        "id", "axis", "data", F.timestamp_micros("t").alias("event_time"), "state"
    ).to(READING_SCHEMA)


@pytest.fixture(scope="session")
def golden(spark):
    rows = [
        ("1", axis, value, offset, "0")
        for axis, values in GOLDEN.items()
        for offset, value in values.items()
    ]
    return reading_frame(spark, rows)


def offset(moment: datetime) -> float:
    """Seconds after the base of the golden readings."""
    return (moment - BASE) / timedelta(seconds=1)


BASE = datetime.fromtimestamp(BASE_MILLIS / 1000)


def keyed(df, *keys):
    return {tuple(row[k] for k in keys): row for row in df.collect()}


def same_rows(left, right) -> bool:
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a = left.select(*columns)
    b = right.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
