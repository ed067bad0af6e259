"""Reader for pivoted feature tables, the input of model training."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spindlewave.schema import PIVOT_FEATURES


def read_feature_table(
    spark: SparkSession, path: str, label: str = "state", fmt: str = "csv", others: str = ""
) -> DataFrame:
    """The sixteen features and the label.

    CSV files carry a header, which must name the columns in order; ``others``
    lists further leading columns (DDL text, such as ``"id string"``). A malformed
    number or a line with too few fields fails the job.
    """
    features = [T.StructField(name, T.DoubleType()) for name in PIVOT_FEATURES]
    lead = T.StructType.fromDDL(others).fields if others else []
    schema = T.StructType([*lead, *features, T.StructField(label, T.StringType())])
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=True, enforceSchema=False, mode="FAILFAST")
    return reader.format(fmt).load(path)
