"""Aggregates over a trailing time range, ending at each reading (both ends included).

``Window.partitionBy(id, axis)`` would send all readings of a machine axis to
one task. The builders here cut the time line of a key into panes as long as the
range. A frame is the part of the reading's own pane up to it and the end of the
pane before, so it is known in the pane if the pane before is copied in. Both parts
are running sums, from either end of a pane: the work per reading does not grow with
the readings in a frame. Readings go once through an exchange by pane and keys, and
nothing is joined back.

Panes with very many readings (``hot_panes``) take another way: their readings are
summed per instant before the exchange, since all readings of an instant have the
same frame, and the frames are joined back, an instant with very many readings in
parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.functions import durations
from spindlewave.functions.signal import ratio
from spindlewave.functions.udaf import SUM, Accumulator, Merge
from spindlewave.schema import KEYS

OWN, EARLIER, WHOLE = 0, 1, 2

# A pane is hot, and an instant joined in parts, beyond this share of all rows and
# this number. So there are fewer than 2 * SHARES panes that are hot by themselves.
SHARES = 10_000
LEAST_SHARE = 10_000

# What a frame's average and count are made of: the states of ``over_range``.
STATES = ("_sum", "_values", "_rows")


def over_range(
    df: DataFrame,
    preceding: timedelta = timedelta(seconds=2),
    keys: Sequence[str] = KEYS,
    time: str = "event_time",
    value: str = "data",
    panes: int = 1,
) -> DataFrame:
    """``df`` with the average of ``value`` and the row count over the range.

    Readings without a time have one frame per key. ``panes`` cuts hot panes into
    as many, for smaller groups where one range holds very many instants. Finding
    the hot panes is a job of its own, over keys and times.
    """
    states = value_states(value)
    framed = range_sums(df, states, preceding, keys, time, panes)
    return framed.select(
        *df.columns, ratio(F.col("_sum"), F.col("_values")).alias("avg_data"), F.col("_rows").alias("count_")
    )


def over_range_with(
    df: DataFrame,
    accumulators: Mapping[str, Accumulator],
    preceding: timedelta = timedelta(seconds=2),
    keys: Sequence[str] = KEYS,
    time: str = "event_time",
    value: str = "data",
    panes: int = 1,
) -> DataFrame:
    """``df`` with user-defined aggregates of ``value`` over the range, by name.

    Python lifts each value to its states and makes the result of the summed states,
    both in Arrow batches; the sums themselves are Spark's.
    """
    states: dict[str, Column] = {}
    results = []
    for number, (name, accumulator) in enumerate(accumulators.items()):
        own = [f"_s{number}_{k}" for k in range(accumulator.width)]
        lifted = accumulator.lifted(F.col(value).cast("double"))
        states |= {column: lifted[k] for k, column in enumerate(own)}
        results.append(accumulator.finished([F.col(column) for column in own]).alias(name))
    return range_sums(df, states, preceding, keys, time, panes).select(*df.columns, *results)


def over_range_merged(
    df: DataFrame,
    merges: Mapping[str, Merge],
    preceding: timedelta = timedelta(seconds=2),
    keys: Sequence[str] = KEYS,
    time: str = "event_time",
    panes: int = 1,
) -> DataFrame:
    """``df`` with aggregates over the range that merge but cannot retract, such as a maximum, by name.

    A frame is the merge of two running aggregates, that of its own pane from the pane's begin
    and that of the pane before to its end, so nothing has ever to be taken out of one.
    """
    states = {f"_m{k}": merge.lift for k, merge in enumerate(merges.values())}
    how = dict(zip(states, merges.values(), strict=True))
    framed = range_sums(df, states, preceding, keys, time, panes, how)
    results = [merge.finish(F.col(f"_m{k}")).alias(name) for k, (name, merge) in enumerate(merges.items())]
    return framed.select(*df.columns, *results)


def value_states(value: str = "data") -> dict[str, Column]:
    data = F.col(value).cast("double")
    there = F.when(data.isNotNull(), 1).otherwise(0)
    return dict(zip(STATES, (data, there.cast("long"), F.lit(1).cast("long")), strict=True))


def range_sums(
    df: DataFrame,
    states: Mapping[str, Column],
    preceding: timedelta,
    keys: Sequence[str] = KEYS,
    time: str = "event_time",
    panes: int = 1,
    how: Mapping[str, Merge] | None = None,
) -> DataFrame:
    """``df`` with the sum over the range of every state, an expression over its columns.

    ``how`` names the states that merge in another way than by addition.
    """
    how = {name: (how or {}).get(name, SUM) for name in states}
    width = durations.micros(preceding)
    if panes < 1 or width % panes:
        raise ValueError("panes must divide the range")
    share, busy = hot_panes(df, width, keys, time)
    rows = df.select(*df.columns, F.unix_micros(time).alias("_t"), *[c.alias(n) for n, c in states.items()])
    rows = rows.withColumn("_offset", F.pmod("_t", F.lit(width)))
    rows = rows.withColumn("_pane", F.expr(f"(_t - _offset) div {width}"))
    if busy is None:
        return _direct(rows, df.columns, how, keys, F.lit(False))

    # A pane is also hot if the one before, which is copied in, is busy.
    rows = rows.alias("l").join(F.broadcast(busy).alias("r"), _same(["_pane", *keys]), "left").select(
        "l.*", *[F.coalesce(f"r.{name}", F.lit(False)).alias(name) for name in ("_hot", "_next_hot")]
    )
    direct = _direct(rows.where("not _hot or not _next_hot"), df.columns, how, keys, F.col("_next_hot"))
    instants = rows.where("_hot or _next_hot").groupBy(*keys, "_t").agg(
        *[merge.aggregate(F.col(name)).alias(name) for name, merge in how.items()], F.count(F.lit(1)).alias("_here")
    )
    frames = instant_frames(instants, preceding, keys, panes, how)
    hot = _attach(rows.where("_hot").select(*df.columns, "_t"), frames, share, keys)
    return direct.unionByName(hot.select(*df.columns, *states))


def hot_panes(
    df: DataFrame, width: int, keys: Sequence[str], time: str
) -> tuple[float, DataFrame | None]:
    """The number of rows from which a pane is hot, and the hot panes, if there are any.

    These are panes with more than half of that number and the ones behind them:
    keys, ``_pane``, and whether the pane (``_hot``) and the next one (``_next_hot``)
    are hot. Rows are counted per pane before the shuffle.
    """
    spark = df.sparkSession
    pane = F.floor(F.unix_micros(time) / F.lit(width)).alias("_pane")
    counts = df.groupBy(*keys, pane).agg(F.count(F.lit(1)).alias("_n"))
    total, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    share = max((total or 0) / SHARES, float(LEAST_SHARE))
    if not total or 2 * most <= share:
        return share, None
    busy = counts.where(F.col("_n") > share / 2).select(*keys, "_pane").collect()
    marks: dict[tuple, list[bool]] = {}
    for *key, at in busy:
        marks.setdefault((*key, at), [False, False])[0] = True
        if at is not None:
            marks.setdefault((*key, at + 1), [False, False])[0] = True
    for *key, at in list(marks):
        if at is not None and marks[(*key, at)][0]:
            marks.setdefault((*key, at - 1), [False, False])[1] = True
    fields = [df.schema[key] for key in keys] + [T.StructField("_pane", T.LongType())]
    fields += [T.StructField(name, T.BooleanType()) for name in ("_hot", "_next_hot")]
    return share, spark.createDataFrame([(*k, *v) for k, v in marks.items()], T.StructType(fields))


def _direct(
    rows: DataFrame, columns: Sequence[str], states: Mapping[str, Merge], keys: Sequence[str], next_hot: Column
) -> DataFrame:
    """Sums over the range, straight from the readings with ``_pane`` and ``_offset``.

    A reading is a row of its own pane and, with nothing but its states, of the next
    one, unless that is hot. Rows of hot panes are only there to be copied.
    """
    hot = F.col("_hot") if "_hot" in rows.columns else F.lit(False)
    own = F.struct(F.col("_pane").alias("pane"), F.lit(OWN).alias("role"))
    copy = F.struct((F.col("_pane") + 1).alias("pane"), F.lit(EARLIER).alias("role"))
    copies = F.filter(
        F.array(F.when(~hot, own), F.when(F.col("_t").isNotNull() & ~next_hot, copy)), lambda c: c.isNotNull()
    )
    rows = rows.withColumn("_copy", F.explode(copies))
    others = [name for name in columns if name not in keys]
    kept = [F.when(F.col("_copy.role") == OWN, F.col(name)).alias(name) for name in others]
    rows = rows.select(*keys, *kept, *states, "_offset", "_copy.pane", "_copy.role")
    group = Window.partitionBy("pane", *keys)
    running = group.orderBy("_offset").rangeBetween(Window.unboundedPreceding, 0)
    closing = group.orderBy(F.desc("_offset")).rangeBetween(Window.unboundedPreceding, 0)
    sums = [
        _both_ends(name, merge, F.col("role") == OWN, running, closing).alias(f"_of{name}")
        for name, merge in states.items()
    ]
    framed = rows.select(*columns, "role", *sums).where(F.col("role") == OWN)
    return framed.select(*columns, *[F.col(f"_of{name}").alias(name) for name in states])


def _both_ends(name: str, merge: Merge, own: Column, running, closing) -> Column:
    """The aggregate of a pane's own rows up to a row, merged with that of the rows of the pane before since then."""
    upto = merge.aggregate(F.when(own, F.col(name))).over(running)
    since = merge.aggregate(F.when(~own, F.col(name))).over(closing)
    return merge.combine(since, upto)


def instant_totals(
    df: DataFrame, keys: Sequence[str] = KEYS, time: str = "event_time", value: str = "data"
) -> DataFrame:
    """Sum, values and rows per key and instant ``_t`` in microseconds."""
    states = value_states(value)
    return df.groupBy(*keys, F.unix_micros(time).alias("_t")).agg(
        *[F.sum(column).alias(name) for name, column in states.items()]
    )


def instant_frames(
    instants: DataFrame,
    preceding: timedelta,
    keys: Sequence[str] = KEYS,
    panes: int = 1,
    how: Mapping[str, Merge] | None = None,
) -> DataFrame:
    """The sums of the frame that ends at each instant, and the instant's own rows ``_here``.

    With several ``panes`` to a range a frame also has the whole panes between.
    """
    states = how or dict.fromkeys(STATES, SUM)
    width = durations.micros(preceding)
    step = width // panes
    offset = F.pmod(F.col("_t"), F.lit(step))
    instants = instants.withColumn("_offset", offset).withColumn(
        "_pane", F.expr(f"(_t - _offset) div {step}")
    )
    own = F.struct(F.col("_pane").alias("pane"), F.lit(OWN).alias("role"))
    earlier = F.struct((F.col("_pane") + panes).alias("pane"), F.lit(EARLIER).alias("role"))
    copies = F.when(F.col("_t").isNull(), F.array(own)).otherwise(F.array(own, earlier))
    rows = instants.withColumn("_copy", F.explode(copies)).select(
        *keys, "_copy.pane", "_copy.role", "_t", "_offset", "_here", *states
    )
    if panes > 1:
        rows = rows.unionByName(_whole_panes(instants, keys, panes, states))

    # Whole panes sort before every instant of the pane, with offset -1.
    # The pane comes first, as sorting by it alone nearly sorts the rows.
    group = Window.partitionBy("pane", *keys)
    running = group.orderBy("_offset").rangeBetween(Window.unboundedPreceding, 0)
    closing = group.orderBy(F.desc("_offset")).rangeBetween(Window.unboundedPreceding, 0)
    sums = [
        _both_ends(name, merge, F.col("role") != EARLIER, running, closing).alias(f"_of{name}")
        for name, merge in states.items()
    ]
    framed = rows.select(*keys, "_t", "_here", "role", *sums).where(F.col("role") == OWN)
    return framed.select(*keys, "_t", "_here", *[F.col(f"_of{name}").alias(name) for name in states])


def _whole_panes(
    instants: DataFrame, keys: Sequence[str], panes: int, states: Mapping[str, Merge]
) -> DataFrame:
    """Pane totals as rows of the ``panes - 1`` following panes."""
    return (
        instants.where(F.col("_t").isNotNull())
        .groupBy(*keys, "_pane")
        .agg(*[merge.aggregate(F.col(name)).alias(name) for name, merge in states.items()])
        .withColumn("_later", F.explode(F.sequence(F.lit(1), F.lit(panes - 1))))
        .select(
            *keys,
            (F.col("_pane") + F.col("_later")).alias("pane"),
            F.lit(WHOLE).alias("role"),
            F.lit(None).cast("long").alias("_t"),
            F.lit(-1).cast("long").alias("_offset"),
            F.lit(None).cast("long").alias("_here"),
            *states,
        )
    )


def _attach(rows: DataFrame, frames: DataFrame, share: float, keys: Sequence[str]) -> DataFrame:
    """Rows with ``_t`` and the sums of their key and instant.

    The frames grow with the table and are never broadcast. An instant with more than
    ``share`` rows is joined in as many parts as it holds such shares: its frame is
    copied, and its rows are dealt out by their content and by the input partition
    they come from, so that copies of one row part too. Fewer than ``SHARES``
    instants are that large, which bounds the broadcast.
    """
    parts = F.ceil(F.col("_here") / share)
    large = frames.where(parts > 1).select(*keys, "_t", parts.alias("_parts"))
    plain = [f.name for f in rows.schema if isinstance(f.dataType, T.AtomicType)]
    part = F.pmod(F.xxhash64(F.spark_partition_id(), *[f"l.{n}" for n in plain]), F.col("_parts"))
    dealt = rows.alias("l").join(F.broadcast(large).alias("r"), _same(["_t", *keys]), "left").select(
        "l.*", F.coalesce(part, F.lit(0).cast("long")).alias("_part")
    )
    first = F.lit(0).cast("long")
    copies = F.when(parts > 1, F.sequence(first, parts - 1)).otherwise(F.array(first))
    copied = frames.withColumn("_part", F.explode(copies))
    added = [name for name in frames.columns if name not in (*keys, "_t", "_here")]
    return (
        dealt.alias("l")
        .join(copied.hint("merge").alias("r"), _same(["_t", "_part", *keys]))
        .select(*[f"l.{name}" for name in rows.columns if name != "_t"], *[f"r.{name}" for name in added])
    )


def _same(names: Sequence[str]) -> Column:
    return reduce(
        lambda left, right: left & right,
        [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in names],
    )
