"""Column names, schemas and domain constants shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Sensor axes, wear states by class code, feature names and order.
AXES = ("X", "Y", "Z", "VB")
WEAR_STATES = ("new", "initial", "normal", "accelerated")
FAILED_STATE = "predict failed"
BASIC_FEATURES = (
    "avg_data",
    "stddev_pop_data",
    "stddev_samp_data",
    "var_pop_data",
    "var_samp_data",
)
SIGNAL_FEATURES = BASIC_FEATURES + ("rms", "peak", "cf", "kv", "s", "if_", "clf")
MEASURES = ("avg", "stddev", "var", "rms")

# Measure-major: x_avg, y_avg, z_avg, vb_avg, x_stddev, ...
PIVOT_FEATURES = tuple(f"{axis.lower()}_{m}" for m in MEASURES for axis in AXES)

# Every spelling of a wear state: class code or name.
STATE_DOMAIN = tuple(str(code) for code in range(len(WEAR_STATES))) + WEAR_STATES

KEYS = ("id", "axis")

READING_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("axis", T.StringType()),
        T.StructField("data", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("state", T.StringType()),
    ]
)

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("axis", T.StringType()),
        T.StructField("wstart", T.TimestampType()),
        *[T.StructField(name, T.DoubleType()) for name in SIGNAL_FEATURES],
        T.StructField("state", T.StringType()),
    ]
)

PIVOT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("rstart", T.TimestampType()),
        *[T.StructField(name, T.DoubleType()) for name in PIVOT_FEATURES],
        T.StructField("state", T.StringType()),
    ]
)
