"""Table sinks for streams and the log of model runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("step", T.IntegerType()),
    ]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("started", T.TimestampType()),
        T.StructField("ended", T.TimestampType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    ]
)


class BatchTable:
    """A ``foreachBatch`` sink: a parquet folder per batch, replaced when repeated."""

    def __init__(self, path: str, transform: Callable[[DataFrame], DataFrame] | None = None):
        self.path = path
        self.transform = transform

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = self.transform(batch) if self.transform else batch
        rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("batch_id")


def log_metrics(
    spark: SparkSession,
    path: str,
    run_id: str,
    metrics: Mapping[str, float],
    step: int = 0,
    ts: datetime | None = None,
) -> None:
    """Append the metrics of a run to the metrics table."""
    ts = ts or datetime.now()
    rows = [(run_id, name, float(value), ts, step) for name, value in metrics.items()]
    spark.createDataFrame(rows, METRIC_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).parquet(path)


def metric_lines(metrics: DataFrame) -> DataFrame:
    """Metrics in their text form, ``epoch_ms value step``."""
    line = F.concat_ws(" ", F.unix_millis("ts"), F.col("value"), F.col("step"))
    return metrics.select("run_id", "metric", line.alias("line"))


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    started: datetime,
    ended: datetime,
    model_path: str,
    params: Mapping[str, object],
) -> None:
    """Append the record of a training run."""
    texts = {name: str(value) for name, value in params.items()}
    row = (run_id, started, ended, model_path, texts)
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
