"""Durations are ``timedelta`` in the API and text or microseconds inside Spark."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(duration: timedelta) -> int:
    value = duration // timedelta(microseconds=1)
    if value <= 0:
        raise ValueError(f"duration must be positive: {duration}")
    return value


def text(duration: timedelta) -> str:
    return f"{micros(duration)} microseconds"


def shift_back(time: Column, duration: timedelta) -> Column:
    """``time - duration``."""
    if not duration:
        return time
    return time - F.expr(f"INTERVAL {micros(duration)} MICROSECONDS")
