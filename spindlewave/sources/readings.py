"""Readers and writers for sensor readings, batch and streaming."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.schema import AXES, READING_SCHEMA


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Readings from lines of id, axis, data, epoch milliseconds and state, split at commas."""
    return parse(spark.read.text(path))


def stream_csv(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream over the files of a folder.

    With ``max_files_per_trigger`` the files must have been written in event
    time order, since the watermark follows what has been read.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse(reader.text(path))


def parse(lines: DataFrame) -> DataFrame:
    """Lines of text to readings; a missing field or malformed number fails the job.

    There is no quoting, fields after the fifth are ignored, and texts are taken
    as they are, but that an empty state is no state.
    """
    parts = F.split("value", ",", -1)
    return lines.select(
        _field(parts, 0, "string").alias("id"),
        _field(parts, 1, "string").alias("axis"),
        _field(parts, 2, "double").alias("data"),
        F.timestamp_millis(_field(parts, 3, "bigint")).alias("event_time"),
        F.nullif(_field(parts, 4, "string"), F.lit("")).alias("state"),
    )


def _field(parts: Column, position: int, kind: str) -> Column:
    text = F.get(parts, F.lit(position))
    value = text if kind == "string" else F.trim(text).try_cast(kind)
    broken = F.raise_error(F.concat(F.lit(f"bad field {position}: "), F.col("value")))
    return F.when(value.isNull(), broken.cast(kind)).otherwise(value)


def write_csv(readings: DataFrame, path: str, axes: Sequence[str] = AXES) -> dict[str, str]:
    """Readings as lines of text in one folder per axis, event time in whole milliseconds.

    All folders are written in one pass. Returns them by axis. What could not be
    read back fails the job: an axis other than those of ``axes``, a missing id,
    value or time, and a comma or line end in a text.
    """
    state = F.coalesce("state", F.lit(""))
    line = F.concat_ws(
        ",", "id", "axis", F.col("data").cast("string"), F.unix_millis("event_time").cast("string"), state
    )
    known = F.col("axis").isin(*axes) & F.col("id").isNotNull()
    whole = known & F.col("data").isNotNull() & F.col("event_time").isNotNull()
    plain = ~F.concat("id", state).rlike("[,\r\n]")
    broken = F.raise_error(F.concat(F.lit("cannot be written: "), F.to_json(F.struct("*"))))
    value = F.when(whole & plain, line).otherwise(broken.cast("string"))
    readings.select(value.alias("value"), F.col("axis").alias("source")).write.partitionBy(
        "source"
    ).text(path)
    return {axis: f"{path}/source={axis}" for axis in axes}


def union_all(sources: Iterable[DataFrame]) -> DataFrame:
    """All rows of same-shaped sources, duplicates included."""
    return reduce(DataFrame.unionByName, sources)


def read_axes(spark: SparkSession, paths: Mapping[str, str], stream: bool = False) -> DataFrame:
    """The union of one CSV source per axis (``{axis: path}``)."""
    reader = stream_csv if stream else read_csv
    return union_all(reader(spark, path) for path in paths.values())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Readings from a parquet table with the columns of a reading."""
    return spark.read.schema(READING_SCHEMA).parquet(path)


def stream_parquet(spark: SparkSession, path: str, schema, **options) -> DataFrame:
    """A parquet file or folder as a stream.

    The braces make the path a pattern, as a stream cannot be opened on a
    single file by name.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    return spark.readStream.schema(schema).options(**options).parquet(f"{folder}/{{{name}}}")


def time_slices(readings: DataFrame, count: int, path: str, time: str = "event_time") -> list[DataFrame]:
    """The readings cut into slices of equal time, in event time order, to be replayed one by one.

    They are written once, to ``path``, by number of the slice; a slice reads its own
    files only. Readings without a time are in the first.
    """
    at = F.unix_micros(time)
    first, last = readings.agg(F.min(at), F.max(at)).first()
    step = 1 if first is None else -(-(last - first + 1) // count)
    number = F.coalesce(F.floor((at - F.lit(first)) / step), F.lit(0)).cast("int")
    return _sliced(readings, number, count, path)


def even_slices(readings: DataFrame, count: int, path: str, time: str = "event_time") -> list[DataFrame]:
    """The readings cut into slices of about as many rows each, in event time order; else as ``time_slices``.

    So no micro-batch of a replay holds a crowded hour whole. The borders are quantiles of the
    times; an instant is never cut.
    """
    at = F.unix_micros(time)
    shares = [k / count for k in range(1, count)]
    borders = readings.agg(F.percentile_approx(at, shares, 10_000)).first()[0] if shares else None
    number = F.lit(0)
    for border in sorted(set(borders or [])):
        number = number + F.when(at > border, 1).otherwise(0)
    return _sliced(readings, number.cast("int"), count, path)


def _sliced(readings: DataFrame, number: Column, count: int, path: str) -> list[DataFrame]:
    readings.withColumn("_slice", number).write.partitionBy("_slice").parquet(path)
    schema = T.StructType([*readings.schema.fields, T.StructField("_slice", T.IntegerType())])
    slices = readings.sparkSession.read.schema(schema).parquet(path)
    return [slices.where(F.col("_slice") == i).drop("_slice") for i in range(count)]


def register_view(readings: DataFrame, name: str = "wear_data") -> DataFrame:
    """Make the readings available to SQL under ``name``."""
    readings.createOrReplaceTempView(name)
    return readings
