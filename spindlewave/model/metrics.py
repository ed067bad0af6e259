"""Metrics of a prediction against its label, in one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlewave.functions.signal import ratio


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: pairs, error rate, root mean squared error, mean absolute error and R2.

    All of them are over the rows with both a label and a prediction (``n``);
    ``n_missing`` counts the others. R2 of a constant label is 1 for a perfect
    prediction and 0 otherwise.
    """
    both = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    y = F.when(both, F.col(label).cast("double"))
    p = F.when(both, F.col(prediction).cast("double"))
    sums = df.agg(
        F.count(y).alias("n"),
        F.count_if(~both).alias("n_missing"),
        F.avg((y != p).cast("int")).alias("error_rate"),
        F.avg((y - p) * (y - p)).alias("_mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("_var"),
    )
    constant = F.when(F.col("_mse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("_var") == 0, constant).otherwise(1 - ratio(F.col("_mse"), F.col("_var")))
    return sums.select("n", "n_missing", "error_rate", F.sqrt("_mse").alias("rmse"), "mae", r2.alias("r2"))
