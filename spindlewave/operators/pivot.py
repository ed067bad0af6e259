"""One row per machine and window: the measures of every axis side by side."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlewave.functions import durations
from spindlewave.functions.states import StateMax
from spindlewave.operators.windows import window_keys, windowed
from spindlewave.schema import AXES, MEASURES

# Measure of the pivoted row -> column of the window features.
MEASURE_COLUMNS = {
    "avg": "avg_data",
    "stddev": "stddev_pop_data",
    "var": "var_pop_data",
    "rms": "rms",
}


def pivot_axes(
    features: DataFrame,
    size: timedelta = timedelta(seconds=2),
    slide: timedelta = timedelta(seconds=2),
    window_size: timedelta = timedelta(seconds=4),
    axes: Sequence[str] = AXES,
    state_domain: Sequence[str] | None = None,
) -> DataFrame:
    """Second step of the cascade: window features into tumbling windows by ``wstart``.

    ``features`` are rows of ``hopping_features`` with ``rms`` and ``state``; ``slide``
    and ``window_size`` are the ones they were made with.

    On a stream the rows must keep their window column (``keep_window``), since
    the watermark travels with it: the tumbling window is then taken over
    ``window_time``, which lies ``window_size - slide`` later in slide units,
    and the start is moved back by as much.
    """
    if features.isStreaming:
        if window_size < slide:
            raise ValueError("window_size must not be shorter than slide")
        time, lag = F.window_time("window"), window_size - slide
        if size != slide or lag % slide:
            raise ValueError("on a stream, size must equal slide and window_size be a multiple")
    else:
        time, lag = F.col("wstart"), timedelta(0)

    timed = features.withColumn("rowtime", time)
    tumble = F.window("rowtime", durations.text(size))
    # The features are few and not stored: to look for long states would compute them twice.
    state_max = StateMax("state", state_domain)
    sums = {
        f"{axis.lower()}_{measure}": F.sum(
            F.when(F.col("axis") == axis, F.coalesce(MEASURE_COLUMNS[measure], F.lit(0.0))).otherwise(F.lit(0.0))
        )
        for measure in MEASURES
        for axis in axes
    }
    reduced = timed.groupBy(tumble.alias("tumble"), "id").agg(
        *[column.alias(name) for name, column in sums.items()], state_max.aggregate().alias("_state")
    )
    return reduced.select(
        "id",
        durations.shift_back(F.col("tumble.start"), lag).alias("rstart"),
        *sums,
        state_max.decode(F.col("_state")).alias("state"),
    )


def pivot_axes_fused(
    df: DataFrame,
    size: timedelta = timedelta(seconds=4),
    slide: timedelta = timedelta(seconds=2),
    axes: Sequence[str] = AXES,
    time: str = "event_time",
    value: str = "data",
    state_domain: Sequence[str] | None = None,
    by_slide: bool = False,
) -> DataFrame:
    """The whole cascade straight from the readings in one aggregate.

    Equal to ``pivot_axes(hopping_features(df))`` when the tumbling windows of
    the second step are as long as the slide, as each then holds exactly one
    window start. It saves a shuffle and, on a stream, a stateful operator. An
    axis without readings, or without any value, is 0 in both. ``by_slide`` as in
    ``windowed``.
    """
    state_max = StateMax("state", state_domain, df)
    aggregates: dict[str, Column] = {"_state": state_max.aggregate()}
    outputs: dict[str, dict[str, Column]] = {measure: {} for measure in MEASURES}
    for axis in axes:
        name = axis.lower()
        reading = F.when(F.col("axis") == axis, F.col(value).cast("double"))
        aggregates[f"_{name}_n"] = F.count(reading)
        aggregates[f"_{name}_avg"] = F.avg(reading)
        aggregates[f"_{name}_var"] = F.var_pop(reading)
        aggregates[f"_{name}_min"] = F.min(reading)
        aggregates[f"_{name}_max"] = F.max(reading)
        outputs["avg"][name] = F.col(f"_{name}_avg")
        outputs["stddev"][name] = F.sqrt(f"_{name}_var")
        outputs["var"][name] = F.col(f"_{name}_var")
        outputs["rms"][name] = (F.col(f"_{name}_max") - F.col(f"_{name}_min")) / 2

    reduced = windowed(df, aggregates, size, slide, ["id"], time, by_slide)
    return state_max.settled(reduced, window_keys(size, slide, ["id"], time)).select(
        "id",
        F.col("window.start").alias("rstart"),
        *[
            F.coalesce(column, F.lit(0.0)).alias(f"{name}_{measure}")
            for measure, columns in outputs.items()
            for name, column in columns.items()
        ],
        state_max.decode(F.col("_state")).alias("state"),
    )
