"""Sensor readings derived from an event table.

A machine is a user modulo 4, an axis an event type, and the wear of the tool
grows by the week of the month, with every fifth reading one state ahead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# Keeps rounded results clear of ties between two-decimal values.
SCALE = 0.7310585786300049

STATES = ("0", "1", "2", "3")

# 100 readings a second from 2024-01-01 on.
SAMPLED_START_MILLIS = 1_704_067_200_000
SAMPLED_STEP_MILLIS = 10


def readings_from_events(events: DataFrame, sampled: bool = False) -> DataFrame:
    """Readings with their ``event_id``.

    ``sampled`` replaces the time of the event by a 100 Hz clock in order of
    ``event_id``.
    """
    axis = (
        F.when(F.col("event_type") == "click", "X")
        .when(F.col("event_type") == "view", "Y")
        .when(F.col("event_type") == "purchase", "Z")
        .otherwise("VB")
    )
    ahead = F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    wear = F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 8).cast("int") + ahead)
    signed = F.when(F.col("event_id") % 2 == 0, F.col("value")).otherwise(-F.col("value"))
    if sampled:
        millis = F.lit(SAMPLED_START_MILLIS) + F.col("event_id") * SAMPLED_STEP_MILLIS
        time = F.timestamp_millis(millis)
    else:
        time = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        (F.col("user_id") % 4 + 1).cast("string").alias("id"),
        axis.alias("axis"),
        (signed * F.lit(SCALE) * (1 + wear * F.lit(0.5))).alias("data"),
        time.alias("event_time"),
        wear.cast("string").alias("state"),
    )
