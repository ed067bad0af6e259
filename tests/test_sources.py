from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spindlewave.schema import AXES, PIVOT_FEATURES, READING_SCHEMA
from spindlewave.sources import readings as sources
from spindlewave.sources.events import readings_from_events
from spindlewave.sources.features import read_feature_table
from tests.conftest import BASE_MILLIS, reading_frame, same_rows


def write_lines(folder, *lines):
    folder.mkdir(exist_ok=True)
    (folder / "part.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_parse(spark, tmp_path):
    path = write_lines(
        tmp_path / "x", f"1,X,-2.5, {BASE_MILLIS + 7} ,new", f" 2,Y,1e2,{BASE_MILLIS},,ignored"
    )
    rows = sources.read_csv(spark, path)
    assert rows.schema.simpleString() == READING_SCHEMA.simpleString()
    found = {(r.id, r.axis, r.data, r.state, r.t) for r in rows.withColumn(
        "t", F.unix_millis("event_time")).collect()}
    assert found == {("1", "X", -2.5, "new", BASE_MILLIS + 7), (" 2", "Y", 100.0, None, BASE_MILLIS)}


@pytest.mark.parametrize("line", ["1,X,abc,0,s", "1,X,1.0,zero,s", "1,X,1.0,0", "", "1,X,,0,s"])
def test_malformed_lines_fail(spark, tmp_path, line):
    path = write_lines(tmp_path / "x", line)
    with pytest.raises(Exception, match="bad field"):
        sources.read_csv(spark, path).collect()


def test_round_trip_in_one_folder_per_axis(spark, tmp_path):
    rows = reading_frame(
        spark,
        [("1", axis, 0.1 * i, i / 1000, "0") for i, axis in enumerate(AXES * 5)],
    )
    paths = sources.write_csv(rows, str(tmp_path / "csv"))
    assert set(paths) == set(AXES)
    assert same_rows(sources.read_axes(spark, paths), rows)
    only_x = sources.read_csv(spark, paths["X"])
    assert {r.axis for r in only_x.collect()} == {"X"} and only_x.count() == 5


@pytest.mark.parametrize(
    "row", [("1", "W", 1.0, 0.0, "0"), ("1", None, 1.0, 0.0, "0"), ("1,2", "X", 1.0, 0.0, "0"), (None, "X", 1.0, 0.0, "0"),
            ("1", "X", None, 0.0, "0"), ("1", "X", 1.0, None, "0"), ("1", "X", 1.0, 0.0, "a,b"), ("1", "X", 1.0, 0.0, "a\nb")]
)
def test_what_cannot_be_read_back_is_not_written(spark, tmp_path, row):
    rows = reading_frame(spark, [("1", "X", 1.0, 0.0, "0"), row])
    with pytest.raises(Exception, match="cannot be written"):
        sources.write_csv(rows, str(tmp_path / "csv"))


def test_no_state_is_read_back_as_none(spark, tmp_path):
    rows = reading_frame(spark, [("1", "X", 1.0, 0.0, None), ("1", "X", 2.0, 1.0, "0")])
    paths = sources.write_csv(rows, str(tmp_path / "csv"), ("X",))
    assert same_rows(sources.read_axes(spark, paths), rows)


def test_union_keeps_duplicates(golden):
    assert sources.union_all([golden, golden, golden]).count() == 3 * golden.count()


def test_stream_reads_what_batch_reads(spark, tmp_path, golden):
    paths = sources.write_csv(golden, str(tmp_path / "csv"), ("X", "Y", "VB"))
    stream = sources.read_axes(spark, paths, stream=True)
    assert stream.isStreaming
    query = (
        stream.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert same_rows(sources.read_table(spark, str(tmp_path / "out")), golden)


def test_even_slices_of_crowded_times(spark, golden, tmp_path):
    crowd = [("1", "X", float(k), 0.001 * (k % 900), "0") for k in range(900)] + [("1", "X", 1.0, 100.0 + k, "0") for k in range(100)]
    df = reading_frame(spark, [*crowd, ("1", "X", 2.0, None, "0")])
    slices = sources.even_slices(df, 5, str(tmp_path / "even"))
    sizes = [part.count() for part in slices]
    assert sum(sizes) == 1001 and max(sizes) <= 2 * sum(sizes) / 5
    ends = [part.agg({"event_time": "max"}).first()[0] for part in slices]
    assert ends == sorted(ends) and slices[0].where("event_time is null").count() == 1
    # One instant stays whole; an empty table has empty slices.
    one = sources.even_slices(reading_frame(spark, [("1", "X", 1.0, 5.0, "0")] * 30), 3, str(tmp_path / "one"))
    assert sorted(part.count() for part in one) == [0, 0, 30]
    assert [p.count() for p in sources.even_slices(golden.limit(0), 2, str(tmp_path / "none"))] == [0, 0]


def test_time_slices(spark, golden, tmp_path):
    slices = sources.time_slices(golden, 3, str(tmp_path / "slices"))
    assert [part.count() for part in slices] == [4, 3, 1]
    assert same_rows(sources.union_all(slices), golden)
    assert sources.time_slices(golden.limit(0), 3, str(tmp_path / "none"))[0].count() == 0


def test_view(spark, golden):
    sources.register_view(golden)
    assert spark.table("wear_data").count() == golden.count()


def test_feature_table(spark, tmp_path):
    values = spark.range(3).select(
        *[(F.col("id") + i).cast("double").alias(n) for i, n in enumerate(PIVOT_FEATURES)],
        F.col("id").cast("string").alias("state"),
    )
    values.write.option("header", True).csv(str(tmp_path / "csv"))
    values.write.parquet(str(tmp_path / "parquet"))
    for fmt in ("csv", "parquet"):
        table = read_feature_table(spark, str(tmp_path / fmt), fmt=fmt)
        assert same_rows(table, values)


def test_malformed_feature_numbers_fail(spark, tmp_path):
    values = spark.range(1).select(*[F.lit("abc").alias(n) for n in PIVOT_FEATURES], F.lit("0").alias("state"))
    values.write.option("header", True).csv(str(tmp_path / "csv"))
    with pytest.raises(Exception, match="(?i)malformed|cannot"):
        read_feature_table(spark, str(tmp_path / "csv")).collect()


def test_feature_table_refuses_other_columns(spark, tmp_path):
    columns = list(PIVOT_FEATURES)
    columns[0], columns[1] = columns[1], columns[0]
    spark.range(1).select(*[F.lit(1.0).alias(n) for n in columns], F.lit("0").alias("state")).write\
        .option("header", True).csv(str(tmp_path / "csv"))
    with pytest.raises(Exception):
        read_feature_table(spark, str(tmp_path / "csv")).collect()


def test_event_adapter_reads_only_what_it_needs(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = readings_from_events(events)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan
