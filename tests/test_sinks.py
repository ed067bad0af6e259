from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from spindlewave.operators.windows import hopping_features
from spindlewave.schema import FEATURE_SCHEMA
from spindlewave.sinks.jdbc import JdbcAppend, table_rows
from spindlewave.sinks.tables import BatchTable
from tests.conftest import same_rows


class FolderAppend(JdbcAppend):
    """The sink with a folder in place of the database."""

    def existing(self, spark, ranges):
        assert len(ranges) == self.connections
        return spark.read.schema(self.schema).parquet(self.target)

    def append(self, rows):
        rows.write.mode("append").parquet(self.target)


def test_table_rows(golden):
    rows = table_rows(hopping_features(golden, state="state"))
    assert rows.columns == FEATURE_SCHEMA.names
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    assert {n for n, k in kinds.items() if k == "double"} == {"peak", "kv", "s"}
    assert kinds["avg_data"] == "float" and kinds["wstart"] == "timestamp"


def test_repeated_batch_is_appended_once(spark, golden, tmp_path):
    features = hopping_features(golden, state="state")
    # A machine without an id must not be written twice either.
    features = features.withColumn("id", F.when(F.col("axis") != "Y", F.col("id")))
    sink = FolderAppend("jdbc:none", str(tmp_path / "table"))
    sink.schema = table_rows(features).schema
    table_rows(features).limit(0).write.parquet(sink.target)
    sink(features.where("axis = 'X'"), 0)  # a part of the batch, then a failure
    sink(features, 0)
    sink(features, 0)
    assert same_rows(spark.read.parquet(sink.target), table_rows(features))


def test_empty_batch(spark, golden, tmp_path):
    FolderAppend("jdbc:none", str(tmp_path))(
        hopping_features(golden, state="state").where("id = 'none'"), 0
    )


def test_jdbc_options():
    sink = JdbcAppend("jdbc:x", properties={"user": "u"}, batch_size=500)
    assert sink.properties == {"batchsize": "500", "user": "u"}
    assert sink.target == "weardata_feature"


def test_ranges_part_the_time_of_a_batch():
    sink = JdbcAppend("jdbc:x", connections=2)
    assert sink.ranges(datetime(2024, 1, 1), datetime(2024, 1, 3)) == [
        "wstart >= TIMESTAMP '2024-01-01 00:00:00' AND wstart < TIMESTAMP '2024-01-02 00:00:00'",
        "wstart >= TIMESTAMP '2024-01-02 00:00:00' AND wstart <= TIMESTAMP '2024-01-03 00:00:00'",
    ]


def test_batch_table_replaces_a_repeated_batch(spark, golden, tmp_path):
    sink = BatchTable(str(tmp_path / "t"), lambda rows: rows.select("axis"))
    for number in (0, 1, 1):
        sink(golden, number)
    assert sink.read(spark).count() == 2 * golden.count()
