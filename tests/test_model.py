from __future__ import annotations

import json
import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from spindlewave.functions.states import state_code, state_label
from spindlewave.model import features, metrics, score, train
from spindlewave.plans.job import PREDICTION_COLUMNS, prediction_writer, scorer
from spindlewave.schema import PIVOT_FEATURES, PIVOT_SCHEMA, WEAR_STATES
from spindlewave.sinks import tables
from spindlewave.streaming.replay import start


@pytest.fixture(scope="module")
def rows(spark):
    """Feature rows whose state shows in their measures."""
    rng = random.Random(11)
    data = []
    for i in range(400):
        code = i % 4
        values = [code * 2.0 + rng.uniform(0, 1.5) for _ in PIVOT_FEATURES]
        data.append((str(i % 5), datetime(2024, 1, 1, 0, i // 60, i % 60), *values, str(code)))
    return spark.createDataFrame(data, PIVOT_SCHEMA).repartition(4).cache()


def test_state_labels_and_codes(spark):
    df = spark.createDataFrame(
        [(0, "new"), (1, " Initial"), (2, "2"), (3, "accelerated"), (7, "x")], "c int, s string"
    )
    found = df.select(state_label(F.col("c")).alias("l"), state_code(F.col("s")).alias("k"))
    assert [tuple(r) for r in found.collect()] == [
        ("new", 0), ("initial", 1), ("normal", 2), ("accelerated", 3), ("predict failed", None)
    ]


def test_split_depends_on_the_key_only(rows):
    first, second = features.split_by_key(rows, ["id", F.col("rstart").cast("string")])
    again, _ = features.split_by_key(
        rows.repartition(7), ["id", F.col("rstart").cast("string")]
    )
    assert first.count() + second.count() == rows.count()
    assert 0.65 < first.count() / rows.count() < 0.85
    assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()


def test_random_split_is_whole(rows):
    first, second = features.split_at_random(rows, seed=1)
    assert first.count() + second.count() == rows.count()


def test_metrics(spark):
    y, p = [0.0, 1.0, 2.0, 3.0, 3.0], [0.0, 1.0, 1.0, 3.0, 0.0]
    row = metrics.evaluate(spark.createDataFrame(list(zip(y, p)), "label double, prediction double"))
    row = row.first()
    errors = [a - b for a, b in zip(y, p)]
    mean = sum(y) / 5
    assert row.n == 5 and row.error_rate == pytest.approx(0.4)
    assert row.rmse == pytest.approx(math.sqrt(sum(e * e for e in errors) / 5))
    assert row.mae == pytest.approx(sum(map(abs, errors)) / 5)
    assert row.r2 == pytest.approx(
        1 - sum(e * e for e in errors) / sum((a - mean) ** 2 for a in y)
    )


def test_metrics_are_over_complete_pairs(spark):
    pairs = [(0.0, 0.0), (1.0, 2.0), (None, 1.0), (2.0, None), (None, None)]
    row = metrics.evaluate(spark.createDataFrame(pairs, "label double, prediction double")).first()
    assert (row.n, row.n_missing, row.error_rate, row.mae) == (2, 3, 0.5, 0.5)
    assert row.r2 == pytest.approx(1 - 0.5 / 0.25)


def test_unknown_labels_fail_or_are_left_out_by_choice(spark, rows):
    odd = rows.limit(1).withColumn("state", F.lit("broken")).unionByName(rows.limit(1).withColumn("state", F.lit(None)))
    mixed = rows.unionByName(odd)
    with pytest.raises(Exception, match="no wear state"):
        features.with_label(mixed).collect()
    assert features.with_label(mixed, unknown="drop").count() == rows.count()
    assert {tuple(r) for r in features.unlabelled(mixed).collect()} == {("broken", 1), (None, 1)}


def test_training_writes_its_record(spark, tmp_path, rows):
    first, second = features.split_at_random(rows, seed=3)
    places = [str(tmp_path / name) for name in ("model", "runs", "metrics")]
    model = train.fit_and_log(first, second, *places, "r", train.forest(trees=2, max_depth=3))
    record = spark.read.schema(tables.RUN_SCHEMA).parquet(places[1]).first()
    assert record.model_path == places[0] and record.params["maxDepth"] == "3" and record.params["minInfoGain"] == "0.0"
    logged = {r.metric: r.value for r in tables.read_metrics(spark, places[2]).collect()}
    assert logged["n"] == second.count() and 0 <= logged["error_rate"] <= 1
    assert score.predict(train.load(places[0]), second).exceptAll(score.predict(model, second)).isEmpty()


def test_r2_of_a_constant_label(spark):
    for prediction, expected in ((1.0, 1.0), (2.0, 0.0)):
        df = spark.createDataFrame([(1.0, prediction)] * 2, "label double, prediction double")
        assert metrics.evaluate(df).first().r2 == expected


@pytest.mark.parametrize(
    "build, options",
    [
        (train.forest, {"trees": 5, "max_depth": 5}),
        (train.boosted_trees, {"rounds": 2, "max_depth": 3}),
        (train.softmax_trees, {"rounds": 4, "max_depth": 5}),
    ],
)
def test_fit_save_load_predict(spark, tmp_path, rows, build, options):
    training, test = features.split_by_key(rows, ["id", F.col("rstart").cast("string")])
    path = str(tmp_path / "model")
    train.save(train.fit(training, build(**options)), path)
    predicted = score.predict(train.load(path), test)
    assert predicted.columns == [*test.columns, "predicted_code", "predicted_state"]
    result = metrics.evaluate(
        predicted.withColumn("label", F.col("state").cast("int")), "label", "predicted_code"
    ).first()
    assert result.n == test.count() and result.error_rate < 0.1
    assert {r.predicted_state for r in predicted.collect()} <= set(WEAR_STATES)


def test_ensemble_losses_per_round(spark, rows):
    model = train.fit(rows, train.boosted_trees(rounds=3, max_depth=2, learning_rate=0.1))
    first, second = features.split_at_random(rows, seed=2)
    losses = train.round_losses(model, {"train": first, "test": second})
    assert losses.count() == 2 * 5 * 3
    by_step = losses.where("split = 'train'").groupBy("step").agg(F.avg("loss").alias("loss"))
    ordered = [r.loss for r in by_step.orderBy("step").collect()]
    assert ordered[0] > ordered[-1]


def test_forest_scores_a_stream(spark, tmp_path, rows):
    rows.write.parquet(str(tmp_path / "rows"))
    model = train.fit(rows, train.forest(trees=3, max_depth=4))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
    query = (
        score.predict(model, stream).writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count()


def test_softmax_trees_score_a_stream_within_its_plan(spark, tmp_path, rows):
    rows.write.parquet(str(tmp_path / "rows"))
    model = train.fit(rows, train.softmax_trees(rounds=3))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
    writer = prediction_writer(stream, model, str(tmp_path / "out"))
    start(writer, spark, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert tuple(found.columns) == PREDICTION_COLUMNS
    expected = scorer(model)(rows)
    assert found.exceptAll(expected).isEmpty() and found.count() == rows.count()
    plan = scorer(model)(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Scala" not in plan


def test_boosted_trees_score_a_stream_by_batch(spark, tmp_path, rows):
    rows.write.parquet(str(tmp_path / "rows"))
    model = train.fit(rows, train.boosted_trees(rounds=1, max_depth=2))
    sink = tables.BatchTable(str(tmp_path / "out"), scorer(model))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    found = sink.read(spark)
    assert tuple(found.columns) == PREDICTION_COLUMNS and found.count() == rows.count()


def test_request_payload(rows):
    row = rows.withColumn("request", score.request_payload()).first()
    request = json.loads(row.request)
    assert request["columns"] == list(PIVOT_FEATURES)
    assert request["data"] == [[row[name] for name in PIVOT_FEATURES]]


def test_reply(spark):
    replies = ["[2.0]", "[0]", "3.9", "[-0.5]", None, "oops"]
    df = spark.createDataFrame([(r,) for r in replies], "r string")
    found = [row.c for row in df.select(score.reply_code(F.col("r")).alias("c")).collect()]
    assert found == [2, 0, 3, 0, -1, None]


def test_requests_hold_null_for_what_is_no_number(spark, rows):
    odd = rows.limit(1).withColumn("x_avg", F.lit(None).cast("double")).withColumn("y_avg", F.lit(float("nan")))
    odd = odd.withColumn("z_avg", F.lit(float("-inf")))
    request = json.loads(odd.withColumn("r", score.request_payload()).first().r, parse_constant=pytest.fail)
    assert request["data"][0][:3] == [None, None, None] and request["data"][0][3] is not None
    seen = score.score_remote(odd, lambda text: str([float(json.loads(text)["data"][0][0] is None)])).first()
    assert (seen.remote_code, seen.remote_error) == (1, None)


def test_other_errors_fail_the_job(rows):
    def broken(text):
        raise KeyError("a fault of the program")

    with pytest.raises(Exception, match="a fault of the program"):
        score.score_remote(rows, broken).collect()


def test_unreadable_predictions(rows):
    found = score.score_remote(rows.limit(2).coalesce(1), lambda text: "[1.0,oops]").collect()
    assert [(r.remote_code, r.remote_error) for r in found] == [(1, None), (None, "unreadable: oops]")]


def by_first_feature(text):
    request = json.loads(text)
    return str([float(int(row[0] // 2)) for row in request["data"]])


def no_reply(text):
    return ""


def too_few(text):
    return "[1.0]"


def refused(text):
    raise ConnectionError("refused")


def test_remote_scoring(rows):
    found = score.score_remote(rows, by_first_feature, rows_per_request=7).collect()
    assert len(found) == rows.count()
    for row in found:
        assert row.remote_code == int(row.x_avg // 2) and row.remote_error is None
        assert row.remote_state == WEAR_STATES[row.remote_code]


def test_remote_without_reply(rows):
    found = score.score_remote(rows, no_reply).select("remote_code", "remote_state").distinct()
    assert [tuple(r) for r in found.collect()] == [(-1, "predict failed")]


@pytest.mark.parametrize("transport", [refused, too_few])
def test_remote_failure_does_not_fail_the_job(rows, transport):
    found = score.score_remote(rows, transport, back_off=0.01)
    bad = found.where("remote_code is null and remote_state = '' and remote_error is not null")
    assert bad.count() == rows.count() == found.count()


class Flaky:
    """Fails the first time for every second request, and answers the sooner the later a row comes."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, text):
        import os
        import time

        numbers = [int(row[0]) for row in json.loads(text)["data"]]
        mark = f"{self.folder}/{numbers[0]}"
        if numbers[0] % 2 and not os.path.exists(mark):
            open(mark, "w").close()
            raise TimeoutError("try again")
        time.sleep(0.02 * (numbers[0] % 5))
        return str([float(n % 4) for n in numbers])


def test_requests_in_flight_with_failures_and_delays(spark, tmp_path):
    zeros = [0.0] * (len(PIVOT_FEATURES) - 1)
    data = [("1", datetime(2024, 1, 1), float(k), *zeros, "0") for k in range(60)]
    rows = spark.createDataFrame(data, PIVOT_SCHEMA).coalesce(1)
    expected = [(float(k), k % 4, None) for k in range(60)]
    for name, options in {"one": {"in_flight": 1}, "many": {"in_flight": 7}}.items():
        (tmp_path / name).mkdir()
        found = score.score_remote(rows, Flaky(tmp_path / name), rows_per_request=3, back_off=0.01, **options).collect()
        assert [(r.x_avg, r.remote_code, r.remote_error) for r in found] == expected
    (tmp_path / "none").mkdir()
    once = score.score_remote(rows, Flaky(tmp_path / "none"), rows_per_request=3, retries=0).collect()
    assert [r.remote_error is None for r in once] == [(k // 3 * 3) % 2 == 0 for k in range(60)]
    with pytest.raises(ValueError, match="in flight"):
        score.score_remote(rows, refused, in_flight=0)


def test_agreement(spark):
    df = spark.createDataFrame(
        [("0", "new", "new"), ("0", "new", "new"), ("1", "new", "")],
        "state string, predicted_state string, remote_state string",
    )
    assert {tuple(r) for r in score.agreement(df).collect()} == {
        ("0", "new", "new", 2), ("1", "new", "", 1)
    }


def test_run_and_metric_logs(spark, tmp_path):
    moment = datetime(2021, 10, 27, 12)
    path = str(tmp_path / "metrics")
    tables.log_metrics(spark, path, "r1", {"r2": 1.0}, 0, moment)
    tables.log_metrics(spark, path, "r1", {"rmse": 0.5, "mae": 0.25}, 1, moment)
    found = tables.read_metrics(spark, path)
    assert {(r.metric, r.value, r.step) for r in found.collect()} == {
        ("r2", 1.0, 0), ("rmse", 0.5, 1), ("mae", 0.25, 1)
    }
    line = tables.metric_lines(found.where("metric = 'r2'")).first().line
    assert line == f"{round(moment.timestamp() * 1000)} 1.0 0"
    runs = str(tmp_path / "runs")
    tables.log_run(spark, runs, "r1", moment, moment, "model", {"max_depth": 12})
    row = spark.read.schema(tables.RUN_SCHEMA).parquet(runs).first()
    assert row.run_id == "r1" and row.params == {"max_depth": "12"}
