"""Labels, feature vectors and splits for the wear-state classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlewave.functions.states import state_code
from spindlewave.schema import PIVOT_FEATURES


def assembler(columns: Sequence[str] = PIVOT_FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features")


def with_label(df: DataFrame, label: str = "state", unknown: str = "fail") -> DataFrame:
    """``df`` with the numeric class of the column ``label``.

    A row without a label, or with one that is no wear state, fails the job;
    ``unknown="drop"`` leaves such rows out (``unlabelled`` counts them).
    """
    code = state_code(F.col(label)).cast("double")
    if unknown == "drop":
        return df.withColumn("label", code).where(F.col("label").isNotNull())
    if unknown != "fail":
        raise ValueError(f"unknown must be fail or drop, not {unknown}")
    text = F.coalesce(F.col(label).cast("string"), F.lit("NULL"))
    broken = F.raise_error(F.concat(F.lit("no wear state: "), text)).cast("double")
    return df.withColumn("label", F.when(code.isNull(), broken).otherwise(code))


def unlabelled(df: DataFrame, label: str = "state") -> DataFrame:
    """Rows per label that is no wear state."""
    return df.where(state_code(F.col(label)).isNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def split_share(keys: Sequence[str | Column]) -> Column:
    """A number in [0, 1) that depends on the key only."""
    text = F.concat_ws("|", *[F.col(k) if isinstance(k, str) else k for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def split_by_key(
    df: DataFrame, keys: Sequence[str | Column], train: float = 0.75
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key; the same rows at every run and layout."""
    share = split_share(keys)
    return df.where(share < train), df.where(share >= train)


def split_at_random(
    df: DataFrame, train: float = 0.75, seed: int | None = None
) -> tuple[DataFrame, DataFrame]:
    first, second = df.randomSplit([train, 1 - train], seed)
    return first, second
