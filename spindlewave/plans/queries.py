"""The registered queries: each runs over the whole event table as sensor readings."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.functions import udaf
from spindlewave.functions.states import state_code, state_label
from spindlewave.model import features as model_features
from spindlewave.model import metrics, score, train
from spindlewave.model.trees import SoftmaxTrees, Tree
from spindlewave.operators.fold import over_range_folded
from spindlewave.operators.over import over_range, over_range_merged, over_range_with
from spindlewave.operators.pivot import pivot_axes, pivot_axes_fused
from spindlewave.operators.windows import hopping_features, tumbling_features
from spindlewave.plans import oracle, sql_views
from spindlewave.plans.job import scorer, wear_features
from spindlewave.schema import AXES, PIVOT_FEATURES, SIGNAL_FEATURES, WEAR_STATES
from spindlewave.session import work_dir
from spindlewave.sinks import tables
from spindlewave.sources import features as feature_tables
from spindlewave.sources import readings as reading_sources
from spindlewave.sources.events import STATES, readings_from_events
from spindlewave.streaming.changelog import changelog, folded
from spindlewave.streaming.late import LateGate
from spindlewave.streaming.over import OverRangeSink, settled, trailing_range, trailing_table
from spindlewave.streaming.replay import Replay, as_batch, without_heartbeat

# The event table has a few readings an hour, so hours take the place of seconds.
HOUR = timedelta(hours=1)
DELAY = 2 * HOUR

# Micro-batches of a replay, and the value of late readings.
SLICES = 4
LATE_DATA = 999.0

Run = Callable[[SparkSession, str], DataFrame]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings(spark: SparkSession, sf_dir: str, sampled: bool = False) -> DataFrame:
    return readings_from_events(events(spark, sf_dir), sampled)


def replayed(
    rows: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    work: str,
    late: bool = False,
    slices: int = SLICES,
    **options,
) -> Replay:
    """The rows as a stream through ``build``, slice by slice in event time order, then closed.

    Slices have about as many rows each. With ``late`` they are equal spans of time, and the last
    one also brings the first one again, too late.
    """
    spark = rows.sparkSession
    cut = reading_sources.time_slices if late else reading_sources.even_slices
    parts = cut(rows, slices, f"{work}/slices")
    if late:
        parts[-1] = parts[-1].unionByName(parts[0].withColumn("data", F.lit(LATE_DATA)))
    rows.limit(0).write.parquet(f"{work}/readings")
    stream = reading_sources.stream_parquet(spark, f"{work}/readings", rows.schema)
    replay = Replay(stream, build, work, **options)
    for part in parts:
        part.write.mode("append").parquet(f"{work}/readings")
        replay.advance()
    return replay.finish()


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Rounded numbers and zone-less timestamps, to compare across engines."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, digits) + F.lit(0.0)
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def signal_rows(df: DataFrame, **options) -> DataFrame:
    return hopping_features(
        df, 4 * HOUR, 2 * HOUR, state="state", state_domain=STATES, **options
    )


def pivot_rows(df: DataFrame) -> DataFrame:
    return pivot_axes(signal_rows(df), 2 * HOUR, 2 * HOUR, 4 * HOUR, state_domain=STATES)


def fused_rows(df: DataFrame) -> DataFrame:
    return pivot_axes_fused(df, 4 * HOUR, 2 * HOUR, state_domain=STATES)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, for input that is read many times."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Windows


def hop_signal_features(spark, sf_dir):
    return shown(signal_rows(readings(spark, sf_dir)))


def hop_signal_features_100hz(spark, sf_dir):
    rows = hopping_features(
        readings(spark, sf_dir, True), state="state", state_domain=STATES, by_slide=True
    )
    return shown(rows)


def tumble_features(spark, sf_dir):
    return shown(tumbling_features(readings(spark, sf_dir), 2 * HOUR))


def hop_features(spark, sf_dir):
    return shown(
        hopping_features(readings(spark, sf_dir), 3 * HOUR, 2 * HOUR, features="basic")
    )


def hop_features_panes(spark, sf_dir):
    """Windows of three hours every two, each reading summed once, for its hour."""
    return shown(
        hopping_features(readings(spark, sf_dir), 3 * HOUR, 2 * HOUR, features="basic", by_slide=True)
    )


def free_state_features(spark, sf_dir):
    """Features with any texts as states, some of them long; no list of states is given."""
    long = F.concat(F.lit("accelerated wear number "), (F.col("event_id") % 5).cast("string"))
    state = F.when(F.col("event_id") % 7 == 0, long).otherwise(F.concat(F.lit("s"), "state"))
    rows = readings(spark, sf_dir).withColumn("state", state)
    return shown(hopping_features(rows, 4 * HOUR, 2 * HOUR, features="basic", state="state"))


def textbook_signal_features(spark, sf_dir):
    return shown(
        hopping_features(readings(spark, sf_dir), 4 * HOUR, 2 * HOUR, features="textbook")
    )


def axis_pivot_features(spark, sf_dir):
    return shown(pivot_rows(readings(spark, sf_dir)))


def axis_pivot_fused(spark, sf_dir):
    return shown(fused_rows(readings(spark, sf_dir)))


def axis_pivot_100hz(spark, sf_dir):
    return shown(pivot_axes_fused(readings(spark, sf_dir, True), state_domain=STATES, by_slide=True))


# SQL text over views


def _view(spark, sf_dir):
    return reading_sources.register_view(readings(spark, sf_dir))


def sql_tumble_features(spark, sf_dir):
    _view(spark, sf_dir)
    return shown(sql_views.tumble_features(spark, "2 hours"))


def sql_hop_signal_features(spark, sf_dir):
    _view(spark, sf_dir)
    return shown(sql_views.hop_signal_features(spark, "4 hours", "2 hours", STATES))


def sql_axis_pivot(spark, sf_dir):
    _view(spark, sf_dir)
    features = sql_views.hop_signal_features(spark, "4 hours", "2 hours", STATES)
    features.createOrReplaceTempView("wear_data_feature")
    return shown(sql_views.axis_pivot(spark, "2 hours", STATES))


# Trailing ranges

OVER_COLUMNS = ("event_id", "id", "axis", "event_time", "data")


def over_range_avg(spark, sf_dir):
    rows = over_range(readings(spark, sf_dir, True))
    return shown(rows.select(*OVER_COLUMNS, "avg_data"))


def over_range_hours(spark, sf_dir):
    rows = over_range(readings(spark, sf_dir), 2 * HOUR, panes=24)
    return shown(rows.select(*OVER_COLUMNS, "avg_data", "count_"))


def over_count(spark, sf_dir):
    rows = over_range(readings(spark, sf_dir, True))
    return shown(rows.select(*OVER_COLUMNS, "avg_data", "count_"))


def over_count_udaf(spark, sf_dir):
    rows = over_range_with(readings(spark, sf_dir, True), {"count_": udaf.row_count()})
    return shown(rows.select(*OVER_COLUMNS, "count_"))


def over_merged(spark, sf_dir):
    """Extremes and the number of states over a range, as running merges of Spark's own aggregates."""
    merges = {
        "max_data": udaf.merged_max("data"), "min_data": udaf.merged_min("data"),
        "states": udaf.merged_distinct("state", STATES),
    }
    rows = over_range_merged(readings(spark, sf_dir), merges, 2 * HOUR, panes=24)
    return shown(rows.select(*OVER_COLUMNS, *merges))


def over_folded(spark, sf_dir):
    """A user-defined maximum over a range, by merges alone."""
    rows = over_range_folded(readings(spark, sf_dir, True), {"max_data": udaf.folded_max()})
    return shown(rows.select(*OVER_COLUMNS, "max_data"))


def sql_over_range_avg(spark, sf_dir):
    reading_sources.register_view(readings(spark, sf_dir, True))
    rows = sql_views.over_range(spark, "avg(data) OVER w AS avg_data")
    return shown(rows.select(*OVER_COLUMNS, "avg_data"))


def sql_over_count_udaf(spark, sf_dir):
    """The average and the registered user-defined count over one named window.

    A pandas function gets each frame anew, so this is for short ranges; ``over_range_with`` and
    ``over_range_folded`` do work that does not depend on the readings in a frame.
    """
    reading_sources.register_view(readings(spark, sf_dir, True))
    udaf.register(spark)
    rows = sql_views.over_range(spark, "avg(data) OVER w AS avg_data, countUdaf(data) OVER w AS count_")
    return shown(rows.select(*OVER_COLUMNS, "avg_data", "count_"))


def sql_count_udaf(spark, sf_dir):
    """The registered function in SQL: counts of a day, merged from those of its windows."""
    _view(spark, sf_dir)
    udaf.register(spark)
    return shown(sql_views.daily_counts(spark, "2 hours"))


def grouped_count_udaf(spark, sf_dir):
    return udaf.grouped_count(readings(spark, sf_dir), ("id", "axis"))


# Sources


def union_sources(spark, sf_dir):
    """One source per axis, each with files of its own, united."""
    rows = readings(spark, sf_dir)
    path = work_dir(spark, "axis-sources")
    rows.withColumn("source", F.col("axis")).write.partitionBy("source").parquet(path)
    sources = [spark.read.schema(rows.schema).parquet(f"{path}/source={axis}") for axis in AXES]
    united = reading_sources.union_all(sources)
    return shown(
        united.groupBy("axis").agg(
            F.count(F.lit(1)).alias("n"), F.sum("data").alias("total"), F.max("data").alias("top")
        )
    )


def positional_rename(spark, sf_dir):
    """Columns named by their position."""
    rows = readings(spark, sf_dir).select("id", "axis", "data", "event_time", "state")
    return shown(rows.toDF("machine", "sensor", "measured", "moment", "wear"))


def csv_sensor_roundtrip(spark, sf_dir):
    rows = readings(spark, sf_dir).select("id", "axis", "data", "event_time", "state")
    paths = reading_sources.write_csv(rows, work_dir(spark, "sensor-csv"))
    return shown(reading_sources.read_axes(spark, paths))


def feature_table_scan(spark, sf_dir):
    path = work_dir(spark, "feature-csv")
    rows = fused_rows(readings(spark, sf_dir)).select("id", *PIVOT_FEATURES, "state")
    rows.write.option("header", True).csv(path)
    return shown(feature_tables.read_feature_table(spark, path, others="id string"))


# Streams


def stream_hop_features(spark, sf_dir):
    work = work_dir(spark, "stream-hop")
    return shown(replayed(readings(spark, sf_dir), signal_rows, work, delay=DELAY).table())


def stream_axis_pivot(spark, sf_dir):
    work = work_dir(spark, "stream-pivot")
    return shown(replayed(readings(spark, sf_dir), fused_rows, work, delay=DELAY).table())


def stream_hop_panes(spark, sf_dir):
    """Panes and windows as two stateful operators of one stream."""
    def panes(df):
        return hopping_features(df, 3 * HOUR, 2 * HOUR, state="state", state_domain=STATES, by_slide=True)

    work = work_dir(spark, "stream-panes")
    return shown(replayed(readings(spark, sf_dir), panes, work, delay=DELAY).table())


def stream_axis_pivot_cascade(spark, sf_dir):
    def cascade(df):
        features = signal_rows(df, keep_window=True)
        return pivot_axes(features, 2 * HOUR, 2 * HOUR, 4 * HOUR, state_domain=STATES)

    work = work_dir(spark, "stream-cascade")
    return shown(replayed(readings(spark, sf_dir), cascade, work, delay=DELAY).table())


def stream_over_range(spark, sf_dir):
    """Frames from the state of each pane, when the watermark passes it."""
    # The heartbeat's time is out of the range of pandas, and it has no frame.
    work = work_dir(spark, "stream-over")
    replay = replayed(readings(spark, sf_dir, True), lambda df: trailing_range(without_heartbeat(df)), work)
    return shown(trailing_table(replay.table()).select(*OVER_COLUMNS, "avg_data", "count_"))


def stream_over_range_settled(spark, sf_dir):
    """The same with readings held one by one and the frames of each micro-batch as a batch."""
    rows = readings(spark, sf_dir, True)
    work = work_dir(spark, "stream-over")
    sink = OverRangeSink(rows.schema, work)
    replayed(rows, settled, work, sink=sink.writer)
    return shown(sink.table(spark).select(*OVER_COLUMNS, "avg_data", "count_"))


def gated(spark, sf_dir, name) -> LateGate:
    """A replay whose last slice also brings the first one again, too late."""
    rows = readings(spark, sf_dir)
    work = work_dir(spark, name)
    parts = reading_sources.time_slices(rows, SLICES, f"{work}/slices")
    parts[-1] = parts[-1].unionByName(parts[0].withColumn("data", F.lit(LATE_DATA)))
    rows.limit(0).write.parquet(f"{work}/readings")
    stream = reading_sources.stream_parquet(spark, f"{work}/readings", rows.schema)
    gate = LateGate(stream, signal_rows, work, 4 * HOUR, 2 * HOUR, delay=DELAY)
    for part in parts:
        part.write.mode("append").parquet(f"{work}/readings")
        gate.advance()
    return gate.finish()


def late_data_drop(spark, sf_dir):
    """Features without the readings that came too late, and how many readings that were."""
    gate = gated(spark, sf_dir, "late")
    return shown(gate.table().withColumn("late_readings", F.lit(gate.late().where("closed = windows").count()).cast("long")))


def late_readings(spark, sf_dir):
    """The readings that came too late, and for how many windows."""
    late = gated(spark, sf_dir, "late").late()
    return shown(late.select("event_id", "id", "axis", "event_time", "data", "windows", "closed"))


def late_window_rows(spark, sf_dir):
    """The same features with the window rows that Spark itself refuses and counts."""
    work = work_dir(spark, "late")
    replay = replayed(readings(spark, sf_dir), signal_rows, work, late=True, delay=DELAY)
    return shown(replay.table().withColumn("late_rows", F.lit(replay.dropped).cast("long")))


def pivot_changelog(spark, sf_dir):
    """The pivoted features as a changelog with row kinds, folded to the table it leaves."""
    log = replayed(
        readings(spark, sf_dir), lambda df: changelog(without_heartbeat(df), 4 * HOUR, 2 * HOUR), work_dir(spark, "changelog"), delay=DELAY
    ).table()
    return shown(folded(log).select("id", "rstart", *PIVOT_FEATURES, "state"))


def feature_sink(spark, sf_dir):
    """Window features of a stream through a per-batch sink."""
    work = work_dir(spark, "feature-sink")
    sink = tables.BatchTable(f"{work}/features")
    replayed(
        readings(spark, sf_dir), signal_rows, work, delay=DELAY,
        sink=lambda rows: rows.writeStream.foreachBatch(as_batch(sink, spark)),
    )
    return shown(sink.read(spark))


# Model


def _split_key():
    return ["id", F.unix_micros("rstart").cast("string")]


def train_test_split(spark, sf_dir):
    rows = fused_rows(readings(spark, sf_dir)).select("id", "rstart", "state")
    share = model_features.split_share(_split_key())
    return shown(rows.withColumn("part", F.when(share < 0.75, "train").otherwise("test")))


def rule_code() -> F.Column:
    """A prediction by rule: the class from the spread of the X axis."""
    return F.least(F.floor(F.col("x_stddev") / 20), F.lit(4)).cast("int")


def model_metrics(spark, sf_dir):
    """Metrics of the rule, where every fifth window start has a state that is none."""
    rows = fused_rows(readings(spark, sf_dir))
    odd = F.floor(F.unix_micros("rstart") / (2 * 3_600_000_000)) % 5 == 0
    state = F.when(odd, F.lit("broken")).otherwise(F.col("state"))
    return shown(metrics.evaluate(rows.select(state_code(state).alias("label"), rule_code().alias("prediction"))))


def state_labels(spark, sf_dir):
    rows = fused_rows(readings(spark, sf_dir)).withColumn("code", rule_code())
    return shown(rows.select("id", "rstart", "code", state_label(F.col("code")).alias("label")))


def scoring_payload(spark, sf_dir):
    """The requests, read back by their column names."""
    rows = fused_rows(readings(spark, sf_dir)).withColumn("request", score.request_payload())
    parsed = F.from_json(
        "request", "struct<columns: array<string>, data: array<array<double>>>"
    )
    named = F.map_from_arrays(F.col("parsed.columns"), F.element_at("parsed.data", 1))
    return shown(
        rows.select("id", "rstart", parsed.alias("parsed"))
        .withColumn("named", named)
        .select("id", "rstart", *[F.col("named")[name].alias(name) for name in PIVOT_FEATURES])
    )


def scoring_reply(spark, sf_dir):
    rows = fused_rows(readings(spark, sf_dir)).withColumn(
        "reply",
        F.when(F.col("x_avg") < 0, F.lit(None))
        .when(F.col("x_avg") > 10, F.lit("error"))
        .otherwise(F.concat(F.lit("["), F.col("state"), F.lit(".7]"))),
    )
    code = score.reply_code(F.col("reply"))
    return shown(rows.select("id", "rstart", code.alias("code"), state_label(code).alias("label")))


def split_rows(spark, sf_dir, name):
    """Feature rows from a table, split by a hash of machine and window."""
    return model_features.split_by_key(stored(fused_rows(readings(spark, sf_dir)), name), _split_key())


def learnt(predicted: DataFrame) -> dict[str, bool]:
    """What a constant prediction fails: better than the commonest state, and more than one class."""
    label = state_code(F.col("state"))
    right = F.count_if(label.eqNullSafe(F.col("predicted_code")))
    counts = predicted.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"), right.alias("right"))
    share = counts.agg(F.sum("right").alias("right"), F.max("n").alias("commonest")).first()
    classes = predicted.agg(F.count_distinct("predicted_code")).first()[0]
    return {"above_commonest": (share.right or 0) > (share.commonest or 0), "several_classes": classes > 1}


def with_learnt(df: DataFrame, found: dict[str, bool]) -> DataFrame:
    return df.select("*", *[F.lit(value).alias(name) for name, value in found.items()])


def model_fit_predict(spark, sf_dir):
    """Softmax trees fitted, saved and read back: test rows by state, whether walks and expressions differ."""
    training, test = split_rows(spark, sf_dir, "model-rows")
    path = work_dir(spark, "model")
    model = train.fit(training)
    train.save(model, path)
    again = train.load(path).transform_batches(test).select("id", "rstart", F.col("prediction").cast("int").alias("again"))
    predicted = stored(score.predict(model, test), "predicted")
    both = predicted.join(again, ["id", "rstart"])
    differ = F.count_if(~F.col("predicted_code").eqNullSafe(F.col("again")))
    known = F.count_if(F.col("predicted_state").isin(*WEAR_STATES))
    rows = both.groupBy("state").agg(F.count(F.lit(1)).alias("n"), known.alias("predicted"), differ.alias("differ"))
    return with_learnt(rows, learnt(predicted))


def model_missing_values(spark, sf_dir):
    """Training and scoring with a third of all features missing, without any put in their place."""
    training, test = split_rows(spark, sf_dir, "missing-rows")

    def thinned(rows):
        gone = [F.pmod(F.xxhash64("id", "rstart", F.lit(name)), F.lit(3)) == 0 for name in PIVOT_FEATURES]
        values = [F.when(~g, F.col(name)).alias(name) for g, name in zip(gone, PIVOT_FEATURES, strict=True)]
        return rows.select("id", "rstart", *values, "state")

    model = train.fit(thinned(training))
    predicted = stored(score.predict(model, thinned(test)), "predicted")
    rows = predicted.groupBy("state").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("predicted_state").isin(*WEAR_STATES)).alias("predicted")
    )
    return with_learnt(rows, learnt(predicted))


def ask_by_rule(text: str) -> str:
    """Stands in for a model server: the class from the spread of the X axis, as ``rule_code``."""
    import json

    request = json.loads(text)
    spread = request["columns"].index("x_stddev")
    return json.dumps([float(min(int(row[spread] // 20), 4)) for row in request["data"]])


def model_round_losses(spark, sf_dir):
    """Losses by round and split: below that of even chances, and in training below the round before."""
    training, test = split_rows(spark, sf_dir, "boosted-rows")
    losses = stored(train.round_losses(train.fit(training), {"train": training, "eval": test}), "losses")
    even = F.log(F.lit(float(len(WEAR_STATES))))
    before = F.coalesce(F.lag("loss").over(Window.partitionBy("split").orderBy("step")), even)
    falls = F.when(F.col("split") == "train", F.col("loss") < before - 1e-3)
    return losses.select("split", "step", (F.col("loss") < even).alias("below_even"), falls.alias("falls"))


def training_run(spark, sf_dir):
    """The record of a training run: its parameters, the rows its metrics are over, and whether it has learnt."""
    training, test = split_rows(spark, sf_dir, "run-rows")
    work = work_dir(spark, "run")
    model = train.fit_and_log(training, test, f"{work}/model", f"{work}/runs", f"{work}/metrics", "run")
    runs = spark.read.schema(tables.RUN_SCHEMA).parquet(f"{work}/runs").where("ended >= started")
    names = runs.select("run_id", F.explode("params").alias("name", "value"))
    logged = tables.read_metrics(spark, f"{work}/metrics").groupBy("run_id").pivot(
        "metric", ["n", "n_missing", "error_rate"]
    ).agg(F.first("value"))
    # The logged error rate is that of the model, and lower than that of the commonest state.
    found = learnt(stored(score.predict(model, test), "predicted"))
    commonest = test.groupBy("state").count().agg(F.max("count") / F.sum("count")).first()[0] or 0.0
    texts = {
        "n": F.col("n").cast("long"), "n_missing": F.col("n_missing").cast("long"),
        "error_below_commonest": 1 - F.col("error_rate") > commonest,
        "several_classes": F.lit(found["several_classes"]),
    }
    each = F.explode(F.create_map(*[x for name, c in texts.items() for x in (F.lit(name), c.cast("string"))]))
    return names.unionByName(logged.select("run_id", each.alias("name", "value")))


def remote_rows(spark, sf_dir):
    return score.score_remote(fused_rows(readings(spark, sf_dir)), ask_by_rule)


def remote_scoring(spark, sf_dir):
    return shown(
        remote_rows(spark, sf_dir).select("id", "rstart", "remote_code", "remote_state")
    )


def _agreement(spark, sf_dir):
    training, _ = split_rows(spark, sf_dir, "agreement-rows")
    return stored(score.predict(train.fit(training), remote_rows(spark, sf_dir)), "agreement")


def prediction_agreement(spark, sf_dir):
    """The trained model beside the remote side: totals by original and remote state."""
    pairs = _agreement(spark, sf_dir)
    known = F.sum(F.when(F.col("predicted_state").isin(*WEAR_STATES), F.col("n")).otherwise(0))
    totals = score.agreement(pairs).groupBy("state", "remote_state").agg(F.sum("n").alias("n"), known.alias("predicted"))
    return with_learnt(totals, learnt(pairs))


def rule_trees() -> SoftmaxTrees:
    """Trees by hand: the class from the spread of the Y axis, in steps of 20."""
    at = PIVOT_FEATURES.index("y_stddev")

    def step(low: float | None, high: float | None) -> Tree:
        """1 from ``low`` up to, but without, ``high``, else 0."""
        borders = [np.nextafter(x, 0) for x in (low, high) if x is not None]
        inside = [0.0, 1.0] if high is None else [1.0, 0.0] if low is None else [0.0, 1.0, 0.0]
        n = len(borders)
        # Inner nodes 0..n-1, each with its leaf on the left; behind them the leaves.
        left = [n + k for k in range(n)]
        right = [k + 1 if k + 1 < n else 2 * n for k in range(n)]
        none = [-1] * (n + 1)
        return Tree(
            np.array([at] * n + none), np.array([*borders, *[0.0] * (n + 1)]), np.zeros(2 * n + 1, bool), np.array(left + none),
            np.array(right + none), np.array([0.0] * n + inside),
        )

    return SoftmaxTrees([[step(None, 20.0), step(20.0, 40.0), step(40.0, 60.0), step(60.0, None)]], list(PIVOT_FEATURES), 4)


def prediction_agreement_table(spark, sf_dir):
    """Counts by original, predicted and remote state, of trees that SQL can write down too."""
    return score.agreement(score.predict(rule_trees(), remote_rows(spark, sf_dir)))


def metrics_log(spark, sf_dir):
    path = work_dir(spark, "metrics")
    values = model_metrics(spark, sf_dir).first().asDict()
    for step, names in enumerate((("rmse", "r2"), ("mae", "error_rate"))):
        chosen = {name: values[name] for name in names}
        tables.log_metrics(spark, path, "run", chosen, step, datetime(2024, 1, 1))
    return tables.read_metrics(spark, path).select("run_id", "metric", "value", "step")


def wear_detection(spark, sf_dir):
    """The whole job: model from a stored table, scored within the stream's plan, compared with walks over a batch."""
    work = work_dir(spark, "wear-detection")
    training, _ = split_rows(spark, sf_dir, "wear-rows")
    train.save(train.fit(training), f"{work}/model")
    model = train.load(f"{work}/model")
    found = replayed(
        readings(spark, sf_dir), lambda df: wear_features(df, 4 * HOUR, 2 * HOUR, STATES), work, delay=DELAY,
        after=scorer(model, ask_by_rule),
    ).table()
    batch = model.transform_batches(fused_rows(readings(spark, sf_dir)))
    batch = batch.select("id", "rstart", F.col("prediction").cast("int").alias("in_batch"))
    both = found.join(batch, ["id", "rstart"], "full")
    same = F.col("predicted_code").eqNullSafe(F.col("in_batch"))
    rows = both.select("id", "rstart", "state", "remote_state", same.alias("as_in_batch"))
    return shown(with_learnt(rows, learnt(found)))


QUERIES: dict[str, Run] = {
    run.__name__: run
    for run in (
        hop_signal_features,
        hop_signal_features_100hz,
        tumble_features,
        hop_features,
        hop_features_panes,
        free_state_features,
        textbook_signal_features,
        axis_pivot_features,
        axis_pivot_fused,
        axis_pivot_100hz,
        sql_tumble_features,
        sql_hop_signal_features,
        sql_axis_pivot,
        over_range_avg,
        over_range_hours,
        over_count,
        over_count_udaf,
        over_merged,
        over_folded,
        sql_over_range_avg,
        sql_over_count_udaf,
        sql_count_udaf,
        grouped_count_udaf,
        union_sources,
        positional_rename,
        csv_sensor_roundtrip,
        feature_table_scan,
        stream_hop_features,
        stream_hop_panes,
        stream_axis_pivot,
        stream_axis_pivot_cascade,
        stream_over_range,
        stream_over_range_settled,
        late_data_drop,
        late_readings,
        late_window_rows,
        pivot_changelog,
        feature_sink,
        train_test_split,
        model_metrics,
        state_labels,
        scoring_payload,
        scoring_reply,
        model_fit_predict,
        model_missing_values,
        model_round_losses,
        training_run,
        remote_scoring,
        prediction_agreement,
        prediction_agreement_table,
        metrics_log,
        wear_detection,
    )
}


def _oracles() -> dict[str, str]:
    signal = oracle.signal(4, 2, "hours")
    pivot = oracle.pivot(4, 2, "hours")
    tumble = oracle.basic(2, 2, "hours")
    pivoted = oracle.pivot_ctes(4, 2, "hours")
    scored = f"{pivoted}, scored AS (SELECT *, CAST(least(floor(x_stddev / 20), 4) AS INTEGER) " \
        "AS code, CAST(least(floor(y_stddev / 20), 4) AS INTEGER) AS other FROM pivoted)"

    def label(code: str) -> str:
        return (
            f"CASE {code} WHEN 0 THEN 'new' WHEN 1 THEN 'initial' WHEN 2 THEN 'normal' "
            "WHEN 3 THEN 'accelerated' ELSE 'predict failed' END"
        )

    odd = "epoch_us(rstart) // 7200000000 % 5 = 0"
    errors = f"""{scored}, pairs AS (
  SELECT CAST(state AS DOUBLE) AS y, CAST(code AS DOUBLE) AS p FROM scored
  WHERE NOT ({odd}) AND state IS NOT NULL AND code IS NOT NULL),
errors AS (
  SELECT count(*) AS n, (SELECT count(*) FROM scored) - count(*) AS n_missing, avg(CASE WHEN y <> p THEN 1 ELSE 0 END) AS error_rate,
         sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
         1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)) AS r2
  FROM pairs, (SELECT avg(y) AS m FROM pairs) means),
shown AS (SELECT n, n_missing, {oracle.rounded(("error_rate", "rmse", "mae", "r2"))} FROM errors)"""

    parts = f"""{pivoted}, shares AS (
  SELECT id, rstart, state,
         CAST('0x' || substr(md5(id || '|' || epoch_us(rstart)), 1, 8) AS BIGINT)
           / 4294967296.0 AS share
  FROM pivoted)"""
    learnt = "true AS above_commonest, true AS several_classes"
    rounds = f"{pivoted}, size AS (SELECT count(*) AS n FROM pivoted) " \
        "SELECT s.split, r.step, true AS below_even, CASE WHEN s.split = 'train' THEN true END AS falls FROM size, " \
        "(VALUES ('train'), ('eval')) s(split), (SELECT CAST(range AS INTEGER) AS step FROM range(10)) r WHERE n > 0"
    # The parameters of the softmax trees in their record.
    settings = {
        "rounds": "10", "max_depth": "12", "learning_rate": "0.007", "subsample": "0.7", "column_sample": "0.7",
        "min_child": "3", "split_penalty": "0.1", "ridge": "2", "classes": "4", "seed": "1000", "bins": "128",
        "local_rows": "100000", "missing": "None",
    }
    values = ", ".join(f"('{name}', '{value}')" for name, value in settings.items())
    run = f"""{parts}, tested AS (SELECT * FROM shares WHERE share >= 0.75)
SELECT 'run' AS run_id, name, value FROM (VALUES {values}) v(name, value)
UNION ALL SELECT 'run', 'n', CAST(count(*) AS VARCHAR) FROM tested
UNION ALL SELECT 'run', 'n_missing', '0'
UNION ALL SELECT 'run', name, 'true' FROM (VALUES ('error_below_commonest'), ('several_classes')) w(name)"""
    first = f"""ends AS (
  SELECT min(epoch_us(event_time)) AS a, max(epoch_us(event_time)) AS b FROM wear_data),
first_slice AS (
  SELECT wear_data.* FROM wear_data, ends WHERE (epoch_us(event_time) - a) // ((b - a + {SLICES}) // {SLICES}) = 0)"""
    head = signal.partition("SELECT id, axis, wstart, round")[0]
    rounded = f"SELECT id, axis, wstart, {oracle.rounded(SIGNAL_FEATURES)}, state"
    late = f"{head}, {first} {rounded}, (SELECT count(*) FROM first_slice) AS late_readings FROM features"
    # Every micro-batch refuses a late window once per key: those of the first slice.
    late_rows = f"""{head}, {first}, refused AS (
  SELECT DISTINCT id, axis, wstart FROM hops JOIN (SELECT event_id AS e FROM first_slice) f ON f.e = hops.event_id)
{rounded}, (SELECT count(*) FROM refused) AS late_rows FROM features"""
    late_table = f"""WITH {oracle.wear_data()}, {first}
SELECT event_id, id, axis, event_time, CAST({LATE_DATA} AS DOUBLE) AS data, 2 AS windows, 2 AS closed FROM first_slice"""

    reply = f"""{pivoted}, replied AS (
  SELECT id, rstart, CASE WHEN x_avg < 0 THEN -1 WHEN x_avg > 10 THEN NULL
                          ELSE CAST(state AS INTEGER) END AS code
  FROM pivoted)
SELECT id, rstart, code, {label("code")} AS label FROM replied"""

    return {
        "hop_signal_features": signal,
        "hop_signal_features_100hz": oracle.signal(4, 2, "seconds", True),
        "tumble_features": tumble,
        "hop_features": oracle.basic(3, 2, "hours"),
        "hop_features_panes": oracle.basic(3, 2, "hours"),
        "free_state_features": oracle.basic(4, 2, "hours").replace(
            "max(state) AS state",
            "max(CASE WHEN event_id % 7 = 0 THEN 'accelerated wear number ' || (event_id % 5) ELSE 's' || state END) AS state",
        ).replace(" FROM features", ", state FROM features"),
        "stream_hop_panes": oracle.signal(3, 2, "hours"),
        "textbook_signal_features": oracle.textbook(4, 2, "hours"),
        "axis_pivot_features": pivot,
        "axis_pivot_fused": pivot,
        "axis_pivot_100hz": oracle.pivot(4, 2, "seconds", True),
        "sql_tumble_features": tumble,
        "sql_hop_signal_features": signal,
        "sql_axis_pivot": pivot,
        "over_range_avg": oracle.over(oracle.OVER_AVG, "'2' SECONDS"),
        "over_range_hours": oracle.over(oracle.OVER_BOTH, "'2' HOURS", False),
        "over_count": oracle.over(oracle.OVER_BOTH, "'2' SECONDS"),
        "over_count_udaf": oracle.over(oracle.OVER_COUNT, "'2' SECONDS"),
        "over_merged": oracle.over(oracle.OVER_MERGED, "'2' HOURS", False),
        "over_folded": oracle.over(oracle.OVER_MAX, "'2' SECONDS"),
        "sql_over_range_avg": oracle.over(oracle.OVER_AVG, "'2' SECONDS"),
        "sql_over_count_udaf": oracle.over(oracle.OVER_BOTH, "'2' SECONDS"),
        "sql_count_udaf": f"WITH {oracle.wear_data()} SELECT id, axis, "
        "CAST(date_trunc('day', event_time) AS TIMESTAMP) AS day, count(*) AS count_ FROM wear_data GROUP BY 1, 2, 3",
        "grouped_count_udaf": f"WITH {oracle.wear_data()} "
        "SELECT id, axis, count(*) AS count_ FROM wear_data GROUP BY id, axis",
        "union_sources": f"WITH {oracle.wear_data()} SELECT axis, count(*) AS n, "
        "round(sum(data), 6) + 0.0 AS total, round(max(data), 6) + 0.0 AS top "
        "FROM wear_data GROUP BY axis",
        "positional_rename": f"WITH {oracle.wear_data()} "
        "SELECT id AS machine, axis AS sensor, round(data, 6) + 0.0 AS measured, event_time AS moment, "
        "state AS wear FROM wear_data",
        "csv_sensor_roundtrip": f"WITH {oracle.wear_data()} "
        "SELECT id, axis, round(data, 6) + 0.0 AS data, "
        "date_trunc('millisecond', event_time) AS event_time, state FROM wear_data",
        "feature_table_scan": f"{pivoted} SELECT id, {oracle.rounded(PIVOT_FEATURES)}, state "
        "FROM pivoted",
        "stream_hop_features": signal,
        "stream_axis_pivot": pivot,
        "stream_axis_pivot_cascade": pivot,
        "stream_over_range": oracle.over(oracle.OVER_BOTH, "'2' SECONDS"),
        "stream_over_range_settled": oracle.over(oracle.OVER_BOTH, "'2' SECONDS"),
        "late_data_drop": late,
        "late_readings": late_table,
        "late_window_rows": late_rows,
        "pivot_changelog": pivot,
        "feature_sink": signal,
        "model_fit_predict": f"{parts} SELECT state, count(*) AS n, count(*) AS predicted, 0 AS differ, {learnt} "
        "FROM shares WHERE share >= 0.75 GROUP BY state",
        "model_missing_values": f"{parts} SELECT state, count(*) AS n, count(*) AS predicted, {learnt} "
        "FROM shares WHERE share >= 0.75 GROUP BY state",
        "model_round_losses": rounds,
        "training_run": run,
        "wear_detection": f"{scored} SELECT id, rstart, state, {label('code')} AS remote_state, "
        f"true AS as_in_batch, {learnt} FROM scored",
        "train_test_split": f"""{parts}
SELECT id, rstart, state, CASE WHEN share < 0.75 THEN 'train' ELSE 'test' END AS part
FROM shares""",
        "model_metrics": f"{errors} SELECT * FROM shown",
        "state_labels": f"{scored} SELECT id, rstart, code, {label('code')} AS label FROM scored",
        "scoring_payload": f"{pivoted} SELECT id, rstart, {oracle.rounded(PIVOT_FEATURES)} "
        "FROM pivoted",
        "scoring_reply": reply,
        "remote_scoring": f"{scored} SELECT id, rstart, code AS remote_code, "
        f"{label('code')} AS remote_state FROM scored",
        "prediction_agreement_table": f"{scored} SELECT state, {label('CAST(least(floor(y_stddev / 20), 3) AS INTEGER)')} AS predicted_state, "
        f"{label('code')} AS remote_state, count(*) AS n FROM scored GROUP BY 1, 2, 3",
        "prediction_agreement": f"{scored} SELECT state, {label('code')} AS remote_state, count(*) AS n, "
        f"count(*) AS predicted, {learnt} FROM scored GROUP BY 1, 2",
        "metrics_log": f"""{errors}
SELECT 'run' AS run_id, 'rmse' AS metric, rmse AS value, 0 AS step FROM shown
UNION ALL SELECT 'run', 'r2', r2, 0 FROM shown
UNION ALL SELECT 'run', 'mae', mae, 1 FROM shown
UNION ALL SELECT 'run', 'error_rate', error_rate, 1 FROM shown""",
    }


ORACLES = _oracles()
