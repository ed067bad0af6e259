"""The wear-detection job: sensor streams in, predictions per machine and window out.

    python -m spindlewave.plans.job --x DIR --y DIR --z DIR --vb DIR \\
        --model MODEL_DIR --out PREDICTION_DIR --checkpoint CHECKPOINT_DIR
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from spindlewave.model.score import HttpTransport, Transport, predict, score_remote
from spindlewave.model.train import Model, load
from spindlewave.model.trees import SoftmaxTrees
from spindlewave.operators.pivot import pivot_axes_fused
from spindlewave.schema import STATE_DOMAIN
from spindlewave.session import build_session
from spindlewave.sinks.tables import BatchTable
from spindlewave.sources.readings import read_axes
from spindlewave.streaming.replay import start, watermarked

PREDICTION_COLUMNS = ("rstart", "id", "state", "predicted_code", "predicted_state", "remote_state")


def scorer(
    model: Model, transport: Transport | None = None
) -> Callable[[DataFrame], DataFrame]:
    """Pivoted feature rows to prediction rows, scored locally and, if asked, remotely."""

    def score(rows: DataFrame) -> DataFrame:
        predicted = predict(model, rows)
        if transport:
            predicted = score_remote(predicted, transport)
        else:
            predicted = predicted.withColumn("remote_state", F.lit(None).cast("string"))
        return predicted.select(*PREDICTION_COLUMNS)

    return score


def wear_features(
    readings: DataFrame,
    size: timedelta = timedelta(seconds=4),
    slide: timedelta = timedelta(seconds=2),
    state_domain=STATE_DOMAIN,
) -> DataFrame:
    """The feature rows that the model scores, from watermarked readings."""
    return pivot_axes_fused(readings, size, slide, state_domain=state_domain)


def prediction_writer(
    features: DataFrame, model: Model, out: str, transport: Transport | None = None
) -> DataStreamWriter:
    """A stream of feature rows, scored and written to the table ``out``.

    Softmax trees score within the streaming plan, and Spark's file sink writes each row
    once. Ensembles of Spark ML that cannot do that score batch by batch.
    """
    score = scorer(model, transport)
    if isinstance(model, SoftmaxTrees):
        return score(features).writeStream.format("parquet").option("path", out)
    return features.writeStream.foreachBatch(BatchTable(out, score))


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for axis in ("x", "y", "z", "vb"):
        parser.add_argument(f"--{axis}", required=True, help=f"folder with the {axis} readings")
    parser.add_argument("--model", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--remote", help="address of a model server")
    parser.add_argument(
        "--states", nargs="*", help="the only states there may be (default: any text); faster if given"
    )
    parser.add_argument("--once", action="store_true", help="stop when all data has been read")
    options = parser.parse_args(arguments)

    spark = build_session("wear-detection")
    paths = {"X": options.x, "Y": options.y, "Z": options.z, "VB": options.vb}
    readings = watermarked(read_axes(spark, paths, stream=True))
    readings.printSchema()
    transport = HttpTransport(options.remote) if options.remote else None
    features = wear_features(readings, state_domain=options.states or None)
    writer = prediction_writer(features, load(options.model), options.out, transport).outputMode("append")
    start(writer, spark, options.checkpoint, once=options.once).awaitTermination()


if __name__ == "__main__":
    main()
