"""Time-domain signal features as expressions over one set of basis aggregates.

A window is first reduced to a few sums (``basis``), which Spark aggregates
partially before the shuffle and in one hash aggregate; every feature is then
plain arithmetic on that row. The four deviations share one variance buffer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def basic_basis(value: Column) -> dict[str, Column]:
    return {
        "_n": F.count(value),
        "_avg": F.avg(value),
        "_var": F.var_pop(value),
    }


def signal_basis(value: Column) -> dict[str, Column]:
    square = value * value
    return {
        **basic_basis(value),
        "_min": F.min(value),
        "_max": F.max(value),
        "_sum2": F.sum(square),
        "_sum4": F.sum(square * square),
        "_sumabs": F.sum(F.abs(value)),
        "_sumroot": F.sum(F.sqrt(F.abs(value))),
    }


def basic_features() -> dict[str, Column]:
    """Mean, deviations and variances over ``basic_basis`` columns."""
    n, var = F.col("_n"), F.col("_var")
    var_samp = var * n / F.nullif(n - 1, F.lit(0))
    return {
        "avg_data": F.col("_avg"),
        "stddev_pop_data": F.sqrt(var),
        "stddev_samp_data": F.sqrt(var_samp),
        "var_pop_data": var,
        "var_samp_data": var_samp,
    }


def signal_features() -> dict[str, Column]:
    """The twelve features over ``signal_basis`` columns.

    ``rms`` and ``peak`` keep the meaning their consumers were trained on:
    ``rms`` is half the peak-to-peak range and ``peak`` is ``sqrt(sum x^2) / n``.
    ``textbook_features`` has the usual definitions.
    """
    n = F.col("_n")
    half_range = (F.col("_max") - F.col("_min")) / 2
    level = ratio(F.sqrt("_sum2"), n)
    mean_root = ratio(F.col("_sumroot"), n)
    return {
        **basic_features(),
        "rms": half_range,
        "peak": level,
        "cf": ratio(half_range, level),
        "kv": ratio(F.col("_sum4"), F.pow(level, F.lit(4.0)) * n),
        "s": ratio(level * n, F.col("_sumabs")),
        "if_": ratio(half_range * n, F.col("_sumabs")),
        "clf": ratio(half_range, mean_root * mean_root),
    }


def textbook_features() -> dict[str, Column]:
    """The usual definitions of the shape factors over ``signal_basis`` columns."""
    n = F.col("_n")
    rms = F.sqrt(ratio(F.col("_sum2"), n))
    peak = F.greatest(F.abs("_max"), F.abs("_min"))
    mean_abs = ratio(F.col("_sumabs"), n)
    mean_root = ratio(F.col("_sumroot"), n)
    return {
        "true_rms": rms,
        "true_peak": peak,
        "crest_factor": ratio(peak, rms),
        "kurtosis_factor": ratio(ratio(F.col("_sum4"), n), F.pow(rms, F.lit(4.0))),
        "form_factor": ratio(rms, mean_abs),
        "pulse_factor": ratio(peak, mean_abs),
        "margin_factor": ratio(peak, mean_root * mean_root),
    }
