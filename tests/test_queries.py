"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from spindlewave.plans import queries

DATA = "/root/testdata/sf0.001"
QUERIES = queries.QUERIES
ORACLES = queries.ORACLES


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normalised(frame: pd.DataFrame) -> list[tuple]:
    def cell(value):
        if pd.isna(value):
            return "NULL"
        if isinstance(value, (int, float)) or hasattr(value, "dtype"):
            return repr(float(value))
        return str(value)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in row) for row in frame.itertuples(index=False))


def test_every_query_is_known():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    found = QUERIES[name](spark, DATA).toPandas()
    assert len(found)
    if name not in ORACLES:
        return
    expected = oracle.sql(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert normalised(found) == normalised(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_job_from_the_command_line(spark, tmp_path):
    from spindlewave.model import train
    from spindlewave.plans import job, queries
    from spindlewave.sources.readings import write_csv

    rows = queries.readings(spark, DATA)
    columns = ("id", "axis", "data", "event_time", "state")
    paths = write_csv(rows.select(*columns), str(tmp_path / "csv"))
    model = str(tmp_path / "model")
    train.save(train.fit(queries.fused_rows(rows), train.forest(trees=3, max_depth=4)), model)
    arguments = [
        *[text for axis, path in paths.items() for text in (f"--{axis.lower()}", path)],
        "--model", model, "--out", str(tmp_path / "out"),
        "--checkpoint", str(tmp_path / "checkpoint"), "--once",
    ]
    job.main(arguments)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert set(job.PREDICTION_COLUMNS) <= set(found.columns) and found.count() > 0
