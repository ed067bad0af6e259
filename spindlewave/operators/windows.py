"""Signal features over tumbling and hopping event-time windows.

The builders work on batch and streaming DataFrames alike. Windows are aligned
to the epoch and half-open.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce
from math import gcd
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlewave.functions import durations, signal
from spindlewave.functions.states import StateMax
from spindlewave.schema import KEYS

FEATURE_SETS = {
    "basic": (signal.basic_basis, signal.basic_features),
    "signal": (signal.signal_basis, signal.signal_features),
    "textbook": (signal.signal_basis, signal.textbook_features),
}


def windowed(
    df: DataFrame,
    aggregates: Mapping[str, Column],
    size: timedelta,
    slide: timedelta,
    keys: Sequence[str],
    time: str,
    by_slide: bool = False,
) -> DataFrame:
    """``aggregates`` per window (column ``window``) and keys.

    With ``by_slide`` every reading is summed once, for the pane it falls into, and the
    panes of a window are put together after a second, small exchange; on a stream that is a
    second stateful operator behind the first. A pane is as long as the greatest common
    divisor of size and slide. That pays where a pane holds many readings of a key; else each
    reading is summed once per window. Names tell how aggregates go together: ``*_n``, ``*_avg`` and ``*_var`` are
    count, mean and population variance of one value, ``*_min``, ``*_max`` and
    ``*_state`` extremes, all others sums.
    """
    if not by_slide:
        window = F.window(time, durations.text(size), durations.text(slide))
        named = [column.alias(name) for name, column in aggregates.items()]
        return df.groupBy(window.alias("window"), *keys).agg(*named)
    step = timedelta(microseconds=gcd(durations.micros(size), durations.micros(slide)))
    count = size // step
    panes = windowed(df, aggregates, step, step, keys, time)
    # A pane lies wholly in every window that it meets; its time carries the watermark.
    window = F.window(F.window_time("window"), durations.text(size), durations.text(slide))
    apart = F.unix_micros("window.start") - F.unix_micros("_window.start")
    slots = panes.withColumn("_window", window).withColumn("_slot", (apart / F.lit(durations.micros(step))).cast("int"))
    merged: dict[str, Column] = {}
    results: dict[str, Column] = {}
    for name in aggregates:
        stem, _, kind = name.rpartition("_")
        results[name] = F.col(name)
        if kind in ("min", "max", "state"):
            merged[name] = (F.min if kind == "min" else F.max)(name)
        elif kind in ("avg", "var"):
            n = [F.col(f"{stem}_n{k}") for k in range(count)]
            mean = [F.col(f"{stem}_mean{k}") for k in range(count)]
            total = F.nullif(reduce(add, n), F.lit(0))
            average = reduce(add, [x * y for x, y in zip(n, mean, strict=True)]) / total
            if kind == "avg":
                results[name] = average
                for k in range(count):
                    own = F.col("_slot") == k
                    merged[f"{stem}_n{k}"] = F.sum(F.when(own, F.col(f"{stem}_n")).otherwise(0))
                    merged[f"{stem}_mean{k}"] = F.sum(F.when(own, F.coalesce(f"{stem}_avg", F.lit(0.0))).otherwise(0.0))
            else:
                merged[f"{stem}_within"] = F.sum(F.col(f"{stem}_n") * F.col(name))
                apart = [x * (y - average) * (y - average) for x, y in zip(n, mean, strict=True)]
                results[name] = (F.col(f"{stem}_within") + reduce(add, apart)) / total
        else:
            merged[name] = F.sum(name)
    grouped = slots.groupBy(F.col("_window").alias("window"), *keys).agg(*[c.alias(n) for n, c in merged.items()])
    return grouped.select("window", *keys, *[c.alias(n) for n, c in results.items()])


def window_keys(size: timedelta, slide: timedelta, keys: Sequence[str], time: str) -> dict[str, Column]:
    """The keys that ``windowed`` groups by, from its rows."""
    window = F.window(time, durations.text(size), durations.text(slide))
    return {"window": window, **{name: F.col(name) for name in keys}}


def tumbling_features(
    df: DataFrame, size: timedelta = timedelta(seconds=2), features: str = "basic", **options
) -> DataFrame:
    """Features per key and tumbling window; options as in ``hopping_features``."""
    return hopping_features(df, size=size, slide=size, features=features, **options)


def hopping_features(
    df: DataFrame,
    size: timedelta = timedelta(seconds=4),
    slide: timedelta = timedelta(seconds=2),
    features: str = "signal",
    keys: Sequence[str] = KEYS,
    time: str = "event_time",
    value: str = "data",
    state: str | None = None,
    state_domain: Sequence[str] | None = None,
    keep_window: bool = False,
    by_slide: bool = False,
) -> DataFrame:
    """Features per key and hopping window, one row each, starting at ``wstart``.

    ``features`` names a set of ``FEATURE_SETS``. With ``state`` the greatest
    state of the window is carried along. ``keep_window`` keeps the window
    column, which a further streaming aggregate needs for its watermark. ``by_slide``
    is explained in ``windowed``.
    """
    basis, outputs = FEATURE_SETS[features]
    aggregates = basis(F.col(value).cast("double"))
    carried: dict[str, Column] = {}
    if state:
        state_max = StateMax(state, state_domain, df)
        aggregates["_state"] = state_max.aggregate()
        carried["state"] = state_max.decode(F.col("_state"))

    reduced = windowed(df, aggregates, size, slide, keys, time, by_slide)
    if state:
        reduced = state_max.settled(reduced, window_keys(size, slide, keys, time))
    return reduced.select(
        *keys,
        *(["window"] if keep_window else []),
        F.col("window.start").alias("wstart"),
        *[column.alias(name) for name, column in {**outputs(), **carried}.items()],
    )
