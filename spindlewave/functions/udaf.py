"""``countUdaf``: a user-defined count of rows, null or not, for SQL and DataFrames.

As a pandas UDF it takes a whole group in one task, in a window a whole partition.
Over large groups use it on partial counts (``countUdafMerge``, ``grouped_count``), over
ranges as an ``Accumulator`` with ``operators.over.over_range_with``, or in SQL over
stretches of time (``plans.sql_views.over_range``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.LongType())
def count_rows(values: pd.Series) -> int:
    return len(values)


@F.pandas_udf(T.LongType())
def merge_counts(totals: pd.Series) -> int:
    return int(totals.sum())


@dataclass(frozen=True)
class Merge:
    """An aggregate by its parts: the state of a row, Spark's aggregate of states, and the merge of two.

    ``combine`` takes the earlier and the later state, either of which may be null. States need
    not add up, and nothing is ever taken out of one.
    """

    lift: Column | None
    aggregate: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column] = lambda state: state


def merged_sum(value: str | Column | None = None) -> Merge:
    """A sum, 0 of nothing; without a value only its way of merging."""

    def combine(a: Column, b: Column) -> Column:
        # The sum of a null keeps its type; that of nothing is 0.
        return F.coalesce(a + b, a, b, F.lit(0))

    return Merge(_column(value), F.sum, combine)


def merged_max(value: str | Column) -> Merge:
    return Merge(_column(value), F.max, F.greatest)


def merged_min(value: str | Column) -> Merge:
    return Merge(_column(value), F.min, F.least)


def merged_distinct(value: str | Column, domain: Sequence[object]) -> Merge:
    """The number of different values of ``domain``, at most 63 of them; others are left out."""
    if len(domain) > 63:
        raise ValueError("a domain has at most 63 values")
    bits = F.lit(0).cast("long")
    for k, known in enumerate(domain):
        bits = F.when(_column(value) == F.lit(known), F.lit(1 << k).cast("long")).otherwise(bits)
    none = F.lit(0).cast("long")
    return Merge(
        bits, F.bit_or, lambda a, b: F.coalesce(a, none).bitwiseOR(F.coalesce(b, none)), lambda state: F.bit_count(state).cast("long")
    )


def _column(value: str | Column | None) -> Column | None:
    return F.col(value) if isinstance(value, str) else value


SUM = merged_sum()


class Fold:
    """A user-defined aggregate whose states merge but cannot be taken apart.

    ``lift`` makes the states of values (an array [values, width]; a null value comes as NaN), ``merge`` the
    states of two stretches of time, the earlier one first, pair by pair, and ``finish`` one result a state
    (NaN becomes null). ``merge`` has to be associative, no more.
    """

    def __init__(
        self,
        lift: Callable[[np.ndarray], np.ndarray],
        merge: Callable[[np.ndarray, np.ndarray], np.ndarray],
        finish: Callable[[np.ndarray], np.ndarray],
        width: int = 1,
        result: T.DataType | None = None,
    ):
        self.lift, self.merge, self.finish, self.width = lift, merge, finish, width
        self.result = result or T.DoubleType()


def folded_max() -> Fold:
    """The maximum, null of nothing."""
    return Fold(
        lambda values: np.where(np.isnan(values), -np.inf, values)[:, None], np.maximum,
        lambda states: np.where(np.isneginf(states[:, 0]), np.nan, states[:, 0]),
    )


def folded_first() -> Fold:
    """The first value in time that is not null; the order of merging matters here."""
    return Fold(
        lambda values: values[:, None], lambda a, b: np.where(np.isnan(a), b, a), lambda states: states[:, 0]
    )


def folded_sketch(registers: int = 64) -> Fold:
    """About how many different values there are, by the largest rank of their hashes in each register."""

    def lift(values: np.ndarray) -> np.ndarray:
        bits = np.where(values == 0, 0.0, values).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bits = (bits ^ (bits >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        bits ^= bits >> np.uint64(29)
        rank = 54 - np.frexp((bits >> np.uint64(11)).astype(float))[1]
        found = np.zeros((len(values), registers))
        known = np.flatnonzero(~np.isnan(values))
        found[known, (bits[known] & np.uint64(registers - 1)).astype(int)] = rank[known]
        return found

    def finish(states: np.ndarray) -> np.ndarray:
        share = 0.7213 / (1 + 1.079 / registers)
        found = share * registers**2 / (2.0**-states).sum(axis=1)
        empty = (states == 0).sum(axis=1)
        few = (found < 2.5 * registers) & (empty > 0)
        return np.where(few, registers * np.log(registers / np.maximum(empty, 1)), found)

    return Fold(lift, np.maximum, finish, registers)


class Accumulator:
    """A user-defined aggregate whose states add up.

    ``lift`` makes the states of each value (an array [values, width]), ``finish`` the
    result of summed states, one result a row. Since states add up, partial states
    merge by addition and what leaves a frame is retracted by subtraction.
    """

    def __init__(
        self,
        lift: Callable[[np.ndarray], np.ndarray],
        finish: Callable[[np.ndarray], np.ndarray],
        width: int = 1,
        result: T.DataType | None = None,
    ):
        self.lift, self.finish, self.width = lift, finish, width
        self.result = result or T.DoubleType()

    def lifted(self, value: Column) -> Column:
        """The array of a value's states; a null value comes as NaN."""
        lift = self.lift

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def run(values: pd.Series) -> pd.Series:
            return pd.Series(list(np.asarray(lift(values.to_numpy(float)), float)))

        return run(value)

    def finished(self, states: Sequence[Column]) -> Column:
        finish, kind = self.finish, self.result

        @F.pandas_udf(kind)
        def run(sums: pd.Series) -> pd.Series:
            return pd.Series(finish(np.stack(sums.to_numpy()) if len(sums) else np.zeros((0, 1))))

        return run(F.array(*states))


def row_count() -> Accumulator:
    """The count of ``countUdaf``: every row, null or not."""
    return Accumulator(
        lambda values: np.ones((len(values), 1)),
        lambda sums: sums[:, 0].astype(np.int64),
        result=T.LongType(),
    )


def mean_square() -> Accumulator:
    """The mean of the squares of the values that are not null."""

    def lift(values: np.ndarray) -> np.ndarray:
        there = ~np.isnan(values)
        return np.stack([np.where(there, values * values, 0.0), there], axis=1)

    def finish(sums: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore", divide="ignore"):
            return sums[:, 0] / sums[:, 1]

    return Accumulator(lift, finish, width=2)


def register(spark: SparkSession) -> None:
    """Make the count and its merge step callable from SQL."""
    spark.udf.register("countUdaf", count_rows)
    spark.udf.register("countUdafMerge", merge_counts)


def grouped(
    df: DataFrame, keys: Sequence[str], value: str | Column, accumulators: Mapping[str, Accumulator]
) -> DataFrame:
    """User-defined aggregates of ``value`` per group, by name.

    No task ever holds a group: values are lifted in Arrow batches, where they are read,
    the states are summed with Spark's own partial aggregation, and Python finishes one
    row per group.
    """
    data = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*keys, *[a.lifted(data).alias(f"_s{k}") for k, a in enumerate(accumulators.values())])
    sums = [
        F.sum(F.col(f"_s{k}")[i]).alias(f"_s{k}_{i}")
        for k, a in enumerate(accumulators.values())
        for i in range(a.width)
    ]
    results = [
        a.finished([F.col(f"_s{k}_{i}") for i in range(a.width)]).alias(name)
        for k, (name, a) in enumerate(accumulators.items())
    ]
    return rows.groupBy(*keys).agg(*sums).select(*keys, *results)


def grouped_count(df: DataFrame, keys: Sequence[str], name: str = "count_") -> DataFrame:
    """The user-defined count per group."""
    return grouped(df, keys, F.lit(0.0), {name: row_count()})
