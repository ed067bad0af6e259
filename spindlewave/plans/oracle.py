"""ANSI SQL of the registered queries, for checking them on another engine."""

from __future__ import annotations

from spindlewave.operators.pivot import MEASURE_COLUMNS
from spindlewave.schema import AXES, BASIC_FEATURES, PIVOT_FEATURES, SIGNAL_FEATURES
from spindlewave.sources.events import SAMPLED_START_MILLIS, SAMPLED_STEP_MILLIS, SCALE

EPOCH = "TIMESTAMP '1970-01-01'"
TEXTBOOK = (
    "true_rms",
    "true_peak",
    "crest_factor",
    "kurtosis_factor",
    "form_factor",
    "pulse_factor",
    "margin_factor",
)


def wear_data(sampled: bool = False) -> str:
    time = "ts"
    if sampled:
        start, step = SAMPLED_START_MILLIS * 1000, SAMPLED_STEP_MILLIS * 1000
        time = f"make_timestamp({start} + event_id * {step})"
    return f"""wear_data AS (
  SELECT event_id, CAST(user_id % 4 + 1 AS VARCHAR) AS id,
         CASE event_type WHEN 'click' THEN 'X' WHEN 'view' THEN 'Y' WHEN 'purchase' THEN 'Z'
                         ELSE 'VB' END AS axis,
         CASE WHEN event_id % 2 = 0 THEN value ELSE -value END
           * CAST({SCALE} AS DOUBLE) * (1 + wear * CAST(0.5 AS DOUBLE)) AS data,
         {time} AS event_time, CAST(wear AS VARCHAR) AS state
  FROM (SELECT *, least(3, (day(ts) - 1) // 8 + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END)
               AS wear
        FROM events) e)"""


def rounded(columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in columns)


def windows(size: int, slide: int, unit: str) -> str:
    """Each reading once per hopping window it falls into."""
    hops = ", ".join(f"({k})" for k in range(-(-size // slide)))
    return f"""hops AS (
  SELECT * FROM (
    SELECT w.*, time_bucket(INTERVAL '{slide} {unit}', event_time, {EPOCH})
                - v.k * INTERVAL '{slide} {unit}' AS wstart
    FROM wear_data w, (VALUES {hops}) v(k)) h
  WHERE event_time < wstart + INTERVAL '{size} {unit}')"""


FEATURES = """sums AS (
  SELECT id, axis, wstart, count(data) AS n, max(state) AS state,
         avg(data) AS avg_data, stddev_pop(data) AS stddev_pop_data,
         stddev_samp(data) AS stddev_samp_data, var_pop(data) AS var_pop_data,
         var_samp(data) AS var_samp_data,
         (max(data) - min(data)) / 2 AS half, max(abs(data)) AS top,
         sqrt(sum(data * data)) AS norm, sum(power(data, 4)) AS fourth,
         avg(abs(data)) AS size, avg(sqrt(abs(data))) AS root
  FROM hops GROUP BY id, axis, wstart),
features AS (
  SELECT sums.*, half AS rms, norm / n AS peak,
         half / nullif(norm / n, 0) AS cf,
         fourth / nullif(power(norm / n, 4) * n, 0) AS kv,
         norm / nullif(size * n, 0) AS s,
         half / nullif(size, 0) AS if_,
         half / nullif(root * root, 0) AS clf,
         norm / sqrt(n) AS true_rms,
         top AS true_peak,
         top / nullif(norm / sqrt(n), 0) AS crest_factor,
         fourth / n / nullif(power(norm / sqrt(n), 4), 0) AS kurtosis_factor,
         norm / sqrt(n) / nullif(size, 0) AS form_factor,
         top / nullif(size, 0) AS pulse_factor,
         top / nullif(root * root, 0) AS margin_factor
  FROM sums)"""


def _pivot(size: int, unit: str) -> str:
    sums = ", ".join(
        f"sum(CASE WHEN axis = '{axis}' THEN {column} ELSE 0 END) AS {axis.lower()}_{measure}"
        for measure, column in MEASURE_COLUMNS.items()
        for axis in AXES
    )
    return f"""pivoted AS (
  SELECT id, time_bucket(INTERVAL '{size} {unit}', wstart, {EPOCH}) AS rstart, {sums},
         max(state) AS state
  FROM features GROUP BY id, time_bucket(INTERVAL '{size} {unit}', wstart, {EPOCH}))"""


def _features(size: int, slide: int, unit: str, columns, state: bool, sampled: bool) -> str:
    tail = ", state" if state else ""
    return f"""WITH {wear_data(sampled)}, {windows(size, slide, unit)}, {FEATURES}
SELECT id, axis, wstart, {rounded(columns)}{tail} FROM features"""


def signal(size: int, slide: int, unit: str, sampled: bool = False) -> str:
    return _features(size, slide, unit, SIGNAL_FEATURES, True, sampled)


def basic(size: int, slide: int, unit: str, sampled: bool = False) -> str:
    return _features(size, slide, unit, BASIC_FEATURES, False, sampled)


def textbook(size: int, slide: int, unit: str) -> str:
    return _features(size, slide, unit, TEXTBOOK, False, False)


def pivot_ctes(size: int, slide: int, unit: str, sampled: bool = False) -> str:
    return (
        f"WITH {wear_data(sampled)}, {windows(size, slide, unit)}, {FEATURES}, "
        f"{_pivot(slide, unit)}"
    )


def pivot(size: int, slide: int, unit: str, sampled: bool = False) -> str:
    return f"""{pivot_ctes(size, slide, unit, sampled)}
SELECT id, rstart, {rounded(PIVOT_FEATURES)}, state FROM pivoted"""


def over(columns: str, frame: str, sampled: bool = True) -> str:
    return f"""WITH {wear_data(sampled)}, framed AS (
  SELECT event_id, id, axis, event_time, data,
         avg(data) OVER w AS avg_data, count(*) OVER w AS count_, max(data) OVER w AS max_data,
         min(data) OVER w AS min_data, count(DISTINCT state) OVER w AS states
  FROM wear_data
  WINDOW w AS (PARTITION BY id, axis ORDER BY event_time
               RANGE BETWEEN INTERVAL {frame} PRECEDING AND CURRENT ROW))
SELECT {columns} FROM framed"""


OVER_AVG = "event_id, id, axis, event_time, round(data, 6) + 0.0 AS data, " \
    "round(avg_data, 6) + 0.0 AS avg_data"
OVER_BOTH = OVER_AVG + ", count_"
OVER_COUNT = "event_id, id, axis, event_time, round(data, 6) + 0.0 AS data, count_"
OVER_MAX = "event_id, id, axis, event_time, round(data, 6) + 0.0 AS data, round(max_data, 6) + 0.0 AS max_data"
OVER_MERGED = OVER_MAX + ", round(min_data, 6) + 0.0 AS min_data, states"
