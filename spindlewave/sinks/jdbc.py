"""JDBC sink for window features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from itertools import pairwise
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlewave.schema import SIGNAL_FEATURES
from spindlewave.session import remove_folder, work_dir

FEATURE_TABLE = "weardata_feature"
# The features that the table holds in double precision.
DOUBLE_COLUMNS = ("peak", "kv", "s")


def table_rows(features: DataFrame) -> DataFrame:
    """Window features with the columns and types of the feature table."""
    return features.select(
        "id",
        "axis",
        "wstart",
        *[
            F.col(name).cast("double" if name in DOUBLE_COLUMNS else "float").alias(name)
            for name in SIGNAL_FEATURES
        ],
        "state",
    )


class JdbcAppend:
    """A ``foreachBatch`` sink that appends feature rows over JDBC.

    A repeated batch may have been written in part. Rows whose key is already in
    the table are therefore left out; only the time range of the batch is read
    back, in as many parts as there are ``connections``. Rows go out in JDBC batches
    from as many tasks; the batch is computed once, into the shared folder.
    """

    def __init__(
        self,
        url: str,
        table: str = FEATURE_TABLE,
        properties: Mapping[str, str] | None = None,
        keys: Sequence[str] = ("wstart", "id", "axis"),
        batch_size: int = 10_000,
        connections: int = 16,
    ):
        self.url = url
        self.target = table
        self.properties = {"batchsize": str(batch_size), **(properties or {})}
        self.keys = list(keys)
        self.connections = connections

    def ranges(self, first: datetime, last: datetime) -> list[str]:
        """Conditions that part the rows from first to last by time."""
        step = (last - first) / self.connections
        borders = [first + step * k for k in range(self.connections)]
        parts = [f"wstart >= TIMESTAMP '{a}' AND wstart < TIMESTAMP '{b}'" for a, b in pairwise(borders)]
        return [*parts, f"wstart >= TIMESTAMP '{borders[-1]}' AND wstart <= TIMESTAMP '{last}'"]

    def existing(self, spark: SparkSession, ranges: Sequence[str]) -> DataFrame:
        return spark.read.jdbc(self.url, self.target, predicates=list(ranges), properties=self.properties)

    def append(self, rows: DataFrame) -> None:
        # Not coalesce, which would also cut the tasks of the join before.
        rows.repartition(self.connections).write.jdbc(
            self.url, self.target, mode="append", properties=self.properties
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = work_dir(spark, "jdbc-batch")
        table_rows(batch).write.parquet(folder)
        try:
            rows = spark.read.schema(table_rows(batch).schema).parquet(folder)
            bounds = rows.agg(F.min("wstart"), F.max("wstart")).first()
            if bounds[0] is None:
                return
            written = self.existing(spark, self.ranges(*bounds)).where(F.col("wstart").between(*map(F.lit, bounds)))
            same = reduce(and_, [rows[key].eqNullSafe(written[key]) for key in self.keys])
            self.append(rows.join(written, same, "left_anti"))
        finally:
            remove_folder(spark, folder)
