"""User-defined aggregates over a trailing range whose states merge but cannot be taken apart.

Readings of one instant have one frame, so states are first merged per key and instant, in
the tasks that read them and again behind a shuffle. The time line is cut into panes as
long as the range. A frame is the end of the pane before, merged with the begin of its own
pane; both are running merges, from either end of a pane, computed for whole batches at
once in doubling steps. A task holds the instants of a pane, never its readings, and
passes over the readings of an instant one batch after the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.functions import durations
from spindlewave.functions.udaf import Fold
from spindlewave.operators.over import LEAST_SHARE, SHARES, _attach
from spindlewave.schema import KEYS

Merging = Callable[[np.ndarray, np.ndarray], np.ndarray]


def running(states: np.ndarray, place: np.ndarray, merge: Merging, backwards: bool = False) -> np.ndarray:
    """Merges of each row with all before it in its run (behind it, if backwards).

    ``place`` is a row's place in its run, counted in the direction of the merge.
    """
    states, by, most = states.copy(), 1, int(place.max(initial=0))
    while by <= most:
        rows = np.flatnonzero(place >= by)
        if backwards:
            states[rows] = merge(states[rows], states[rows + by])
        else:
            states[rows] = merge(states[rows - by], states[rows])
        by *= 2
    return states


def places(fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's run and its place there, from where runs begin."""
    run = np.cumsum(fresh) - 1
    begins = np.flatnonzero(fresh)
    return run, np.arange(len(fresh)) - begins[run] if len(fresh) else run


def changes(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Where a row differs from the one before in the columns ``names``; null equals null."""
    found = np.ones(len(batch), bool)
    if len(batch) > 1:
        found[1:] = False
        for name in names:
            column = batch.column(name)
            a, b = column.slice(0, len(column) - 1), column.slice(1)
            differ = pc.fill_null(pc.not_equal(a, b), False)
            lone = pc.xor(pc.is_null(a), pc.is_null(b))
            found[1:] |= np.asarray(pc.or_(differ, lone))
    return found


def glued(batches: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    """Batches with the same columns as one; whether columns may be null does not matter."""
    names = batches[0].schema.names
    return pa.RecordBatch.from_arrays([pa.concat_arrays([b.column(n) for b in batches]) for n in names], names)


def _states(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("_state").to_pylist()), "<f8").reshape(-1, width)


def _packed(states: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(states, "<f8")], pa.binary())


def merging(folds: Sequence[Fold]) -> Merging:
    """The merge of the states of several folds side by side."""
    cuts = np.cumsum([0, *(fold.width for fold in folds)])

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        parts = [fold.merge(a[:, x:y], b[:, x:y]) for fold, x, y in zip(folds, cuts[:-1], cuts[1:], strict=True)]
        return np.concatenate(parts, axis=1)

    return merge


def merge_runs(rows: DataFrame, names: Sequence[str], folds: Sequence[Fold]) -> DataFrame:
    """Neighbouring rows with equal ``names`` as one, with states merged and ``_here`` summed."""
    width, merge = sum(fold.width for fold in folds), merging(folds)
    columns = [*names, "_here", "_state"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last run, which may go on
        for batch in batches:
            batch = batch.select(columns)
            if held is not None:
                batch = glued([held, batch])
            if not len(batch):
                continue
            fresh = changes(batch, names)
            run_of, place = places(fresh)
            states = running(_states(batch, width), place, merge)
            begins = np.flatnonzero(fresh)
            last = np.append(begins[1:], len(batch)) - 1
            here = np.add.reduceat(np.asarray(batch.column("_here")), begins)
            own = [batch.column(name).take(pa.array(begins)) for name in names]
            merged = pa.RecordBatch.from_arrays([*own, pa.array(here), _packed(states[last])], columns)
            yield merged.slice(0, len(merged) - 1)
            held = merged.slice(len(merged) - 1)
        if held is not None:
            yield held

    return rows.select(*columns).mapInArrow(run, rows.select(*columns).schema)


def over_range_folded(
    df: DataFrame,
    folds: Mapping[str, Fold],
    preceding: timedelta = timedelta(seconds=2),
    keys: Sequence[str] = KEYS,
    time: str = "event_time",
    value: str = "data",
) -> DataFrame:
    """``df`` with user-defined aggregates of ``value`` over the range (both ends included), by name.

    Readings of one instant merge in no certain order. Readings without a time have one frame per key.
    """
    every = list(folds.values())
    width, total_width, merge = durations.micros(preceding), sum(fold.width for fold in every), merging(every)
    rows = df.withColumn("_t", F.unix_micros(time))

    def lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column("_value").fill_null(np.nan))
            states = np.concatenate([np.asarray(fold.lift(values), float) for fold in every], axis=1)
            own = [batch.column(name) for name in (*keys, "_t")]
            ones = pa.array(np.ones(len(batch), np.int64))
            yield pa.RecordBatch.from_arrays([*own, ones, _packed(states)], [*keys, "_t", "_here", "_state"])

    names = [*keys, "_t"]
    fields = [rows.schema[name] for name in names]
    schema = T.StructType([*fields, T.StructField("_here", T.LongType()), T.StructField("_state", T.BinaryType())])
    lifted = rows.select(*names, F.col(value).cast("double").alias("_value")).mapInArrow(lift, schema)
    instants = merge_runs(lifted.sortWithinPartitions(*names), names, every)
    instants = merge_runs(instants.repartition(*names).sortWithinPartitions(*names), names, every)

    # Every instant is a row of its own pane and of the next one.
    offset = F.pmod("_t", F.lit(width))
    pane = F.expr(f"(_t - pmod(_t, {width})) div {width}")
    copies = F.when(F.col("_t").isNull(), F.array(F.struct(pane.alias("_pane"), F.lit(True).alias("_own")))).otherwise(
        F.array(F.struct(pane.alias("_pane"), F.lit(True).alias("_own")), F.struct((pane + 1).alias("_pane"), F.lit(False).alias("_own")))
    )
    dealt = instants.withColumn("_offset", F.coalesce(offset, F.lit(0))).withColumn("_copy", F.explode(copies))
    dealt = dealt.select(*keys, "_copy._pane", "_copy._own", "_offset", "_t", "_here", "_state")
    group = ["_pane", *keys]
    dealt = dealt.repartition(*group).sortWithinPartitions(*group, "_own", "_offset")
    results = [T.StructField(name, fold.result) for name, fold in folds.items()]
    schema = T.StructType([*fields, T.StructField("_here", T.LongType()), *results])

    def frames(part: pa.RecordBatch) -> pa.RecordBatch:
        """The frames of whole panes."""
        run, _ = places(changes(part, group))
        own = np.asarray(part.column("_own"))
        offset, states = np.asarray(part.column("_offset")), _states(part, total_width)
        at, before = np.flatnonzero(own), np.flatnonzero(~own)
        upto = running(states[at], places(np.append(True, run[at][1:] != run[at][:-1]))[1], merge) if len(at) else states[at]
        if len(before):
            back = run[before][::-1]
            place = places(np.append(True, back[1:] != back[:-1]))[1][::-1]
            since = running(states[before], place, merge, backwards=True)
            # The first instant of the pane before that is still in the frame.
            spot = np.searchsorted(run[before] * (width + 1) + offset[before], run[at] * (width + 1) + offset[at])
            there = (spot < len(before)) & (run[before][np.minimum(spot, len(before) - 1)] == run[at])
            upto[there] = merge(since[spot[there]], upto[there])
        mine = part.take(pa.array(at))
        found, cut = [], 0
        for fold, field in zip(every, results, strict=True):
            values = np.asarray(fold.finish(upto[:, cut : cut + fold.width]), float)
            found.append(pa.array(values, from_pandas=True).cast(ARROW[field.dataType.typeName()], safe=False))
            cut += fold.width
        return pa.RecordBatch.from_arrays([*[mine.column(name) for name in (*names, "_here")], *found], schema.fieldNames())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            # The last pane of the batch may go on in the next one.
            whole = glued([*held, batch]) if held else batch
            last = int(np.flatnonzero(changes(whole, group))[-1])
            if last:
                yield frames(whole.slice(0, last))
            held = [whole.slice(last)]
        if held:
            yield frames(held[0])

    found = dealt.mapInArrow(scan, schema)
    share = max(df.count() / SHARES, float(LEAST_SHARE))
    return _attach(rows, found, share, keys).select(*df.columns, *folds)


# Results that folds may have, as Arrow types.
ARROW = {"double": pa.float64(), "long": pa.int64(), "bigint": pa.int64(), "integer": pa.int32(), "int": pa.int32()}
