"""The feature queries as Spark SQL text, over the views ``wear_data`` and ``wear_data_feature``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from spindlewave.operators.pivot import MEASURE_COLUMNS
from spindlewave.schema import AXES


def state_max(states: Sequence[str] | None) -> str:
    """The greatest state in text order; by rank, which keeps a hash aggregate, if all are known."""
    if states is None:
        return "max(state)"
    known = sorted(set(states))
    ranks = " ".join(f"WHEN state = '{state}' THEN {rank}" for rank, state in enumerate(known))
    unknown = "raise_error('state outside its domain: ' || state)"
    names = ", ".join(f"'{state}'" for state in known)
    return f"get(array({names}), max(CASE {ranks} WHEN state IS NOT NULL THEN {unknown} END))"


def tumble_features(spark: SparkSession, size: str) -> DataFrame:
    return spark.sql(
        f"""
        SELECT id, axis, window.start AS wstart,
               avg(data) AS avg_data,
               stddev_pop(data) AS stddev_pop_data,
               stddev_samp(data) AS stddev_samp_data,
               var_pop(data) AS var_pop_data,
               var_samp(data) AS var_samp_data
        FROM wear_data
        GROUP BY window(event_time, '{size}'), id, axis
        """
    )


def hop_signal_features(
    spark: SparkSession, size: str, slide: str, states: Sequence[str] | None = None
) -> DataFrame:
    return spark.sql(
        f"""
        WITH sums AS (
          SELECT id, axis, window.start AS wstart, count(data) AS n, avg(data) AS mean,
                 var_pop(data) AS var, (max(data) - min(data)) / 2 AS rms,
                 sqrt(sum(data * data)) / nullif(count(data), 0) AS peak,
                 sum(power(data, 4)) AS sum4, sum(abs(data)) AS sumabs,
                 sum(sqrt(abs(data))) AS sumroot, {state_max(states)} AS state
          FROM wear_data
          GROUP BY window(event_time, '{size}', '{slide}'), id, axis
        )
        SELECT id, axis, wstart,
               mean AS avg_data,
               sqrt(var) AS stddev_pop_data,
               sqrt(var * n / nullif(n - 1, 0)) AS stddev_samp_data,
               var AS var_pop_data,
               var * n / nullif(n - 1, 0) AS var_samp_data,
               rms,
               peak,
               rms / nullif(peak, 0) AS cf,
               sum4 / nullif(power(peak, 4) * n, 0) AS kv,
               peak * n / nullif(sumabs, 0) AS s,
               rms * n / nullif(sumabs, 0) AS if_,
               rms / nullif(power(sumroot / n, 2), 0) AS clf,
               state
        FROM sums
        """
    )


def axis_pivot(
    spark: SparkSession, size: str, states: Sequence[str] | None = None
) -> DataFrame:
    sums = ",\n".join(
        f"sum(CASE WHEN axis = '{axis}' THEN {column} ELSE 0 END) AS {axis.lower()}_{measure}"
        for measure, column in MEASURE_COLUMNS.items()
        for axis in AXES
    )
    return spark.sql(
        f"""
        SELECT id, window.start AS rstart, {sums}, {state_max(states)} AS state
        FROM wear_data_feature
        GROUP BY window(wstart, '{size}'), id
        """
    )


def daily_counts(spark: SparkSession, size: str) -> DataFrame:
    return spark.sql(
        f"""
        SELECT id, axis, day, countUdafMerge(n) AS count_
        FROM (SELECT id, axis, date_trunc('DAY', window.start) AS day, count(*) AS n
              FROM wear_data
              GROUP BY window(event_time, '{size}'), id, axis)
        GROUP BY id, axis, day
        """
    )


def over_range(spark: SparkSession, aggregates: str, seconds: int = 2, stretch: int = 32) -> DataFrame:
    """Readings with ``aggregates``, SQL text over the window ``w``: the last ``seconds``.

    The time line of a key is cut into stretches of ``stretch`` ranges, so that a
    window partition does not grow with the table; readings of a stretch's last range
    are copied into the next, so that every frame is whole.
    """
    width = seconds * 1_000_000
    length = width * stretch
    return spark.sql(
        f"""
        WITH placed AS (
          SELECT *, pmod(unix_micros(event_time), {length}) AS place FROM wear_data
        ),
        copied AS (
          SELECT *, floor(unix_micros(event_time) / {length}) + later AS stretch
          FROM placed LATERAL VIEW explode(
            CASE WHEN place >= {length - width} THEN array(0, 1) ELSE array(0) END) AS later
        ),
        framed AS (
          SELECT *, {aggregates}
          FROM copied
          WINDOW w AS (PARTITION BY id, axis, stretch ORDER BY event_time
                       RANGE BETWEEN INTERVAL '{seconds}' SECOND PRECEDING AND CURRENT ROW)
        )
        SELECT * EXCEPT (place, later, stretch) FROM framed WHERE later = 0
        """
    )
