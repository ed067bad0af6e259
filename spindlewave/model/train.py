"""Training, saving and loading of the wear-state classifier."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlewave.model.boosting import Softmax
from spindlewave.model.features import assembler, with_label
from spindlewave.model.metrics import evaluate
from spindlewave.model.score import predict
from spindlewave.model.trees import SoftmaxTrees
from spindlewave.session import path_exists
from spindlewave.sinks.tables import log_metrics, log_run

# Training parameters of the boosted trees. The split penalty is a gain
# summed over the rows of a node, the least child a sum of second derivatives.
ROUNDS = 10
MAX_DEPTH = 12
LEARNING_RATE = 0.007
SUBSAMPLE = 0.7
COLUMN_SAMPLE = 0.7
MIN_CHILD = 3
SPLIT_PENALTY = 0.1
RIDGE = 2
SEED = 1000

Model = PipelineModel | SoftmaxTrees


def softmax_trees(**options) -> Softmax:
    """Boosted trees with one softmax objective over all classes; ``options`` override the fixed values."""
    values = dict(
        rounds=ROUNDS, max_depth=MAX_DEPTH, learning_rate=LEARNING_RATE, subsample=SUBSAMPLE, column_sample=COLUMN_SAMPLE,
        min_child=MIN_CHILD, split_penalty=SPLIT_PENALTY, ridge=RIDGE, seed=SEED,
    )
    return Softmax(**{**values, **options})


def boosted_trees(
    rounds: int = ROUNDS,
    max_depth: int = MAX_DEPTH,
    learning_rate: float = LEARNING_RATE,
    subsample: float = SUBSAMPLE,
    column_sample: float = COLUMN_SAMPLE,
    min_child: int = MIN_CHILD,
    least_gain: float = 0.0,
    seed: int = SEED,
    parallelism: int = 4,
) -> Estimator:
    """Spark ML's boosted trees, one binary ensemble per class.

    ``least_gain`` is Spark's, a mean over the rows of a node: a penalty summed over rows
    has no counterpart there.
    """
    trees = GBTClassifier(
        maxIter=rounds,
        maxDepth=max_depth,
        stepSize=learning_rate,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(column_sample),
        minInstancesPerNode=min_child,
        minInfoGain=least_gain,
        seed=seed,
        maxMemoryInMB=512,
    )
    return OneVsRest(classifier=trees, parallelism=parallelism)


def forest(
    trees: int = ROUNDS,
    max_depth: int = MAX_DEPTH,
    subsample: float = SUBSAMPLE,
    column_sample: float = COLUMN_SAMPLE,
    min_child: int = MIN_CHILD,
    least_gain: float = 0.0,
    seed: int = SEED,
) -> Estimator:
    """A random forest, which is multi-class by itself and can score a stream directly."""
    return RandomForestClassifier(
        numTrees=trees,
        maxDepth=max_depth,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(column_sample),
        minInstancesPerNode=min_child,
        minInfoGain=least_gain,
        seed=seed,
        maxMemoryInMB=512,
    )


def fit(
    rows: DataFrame, estimator: Estimator | Softmax | None = None, label: str = "state", unknown: str = "fail"
) -> Model:
    """Train on pivoted feature rows; softmax trees if nothing else is given.

    Training reads its input many times, so ``rows`` should come from a table,
    not from the feature aggregation itself. Rows without a known label fail the
    job, or are left out with ``unknown="drop"``.
    """
    estimator = estimator or softmax_trees()
    labelled = with_label(rows, label, unknown)
    if isinstance(estimator, Softmax):
        return estimator.fit(labelled)
    return Pipeline(stages=[assembler(), estimator]).fit(labelled)


def parameters(estimator: Estimator | Softmax) -> dict[str, object]:
    """The parameters of an estimator; of Spark ML's boosted trees those of a class's ensemble."""
    if isinstance(estimator, Softmax):
        return estimator.parameters()
    inner = estimator.getClassifier() if isinstance(estimator, OneVsRest) else estimator
    names = ("maxIter", "numTrees", "maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy",
             "minInstancesPerNode", "minInfoGain", "seed")
    return {name: inner.getOrDefault(name) for name in names if inner.hasParam(name)}


def fit_and_log(
    rows: DataFrame,
    test: DataFrame,
    model_path: str,
    runs_path: str,
    metrics_path: str,
    run_id: str,
    estimator: Estimator | Softmax | None = None,
    label: str = "state",
) -> Model:
    """Train, save the model, and write the run's record and the metrics on ``test``."""
    spark = rows.sparkSession
    estimator = estimator or softmax_trees()
    started = datetime.now()
    model = fit(rows, estimator, label)
    save(model, model_path)
    ended = datetime.now()
    predicted = with_label(predict(model, test), label)
    found = evaluate(predicted, "label", "predicted_code").first().asDict()
    log_run(spark, runs_path, run_id, started, ended, model_path, parameters(estimator))
    log_metrics(spark, metrics_path, run_id, {k: v for k, v in found.items() if v is not None}, ts=ended)
    return model


def save(model: Model, path: str) -> None:
    if isinstance(model, SoftmaxTrees):
        model.save(path)
    else:
        model.write().overwrite().save(path)


def load(path: str) -> Model:
    return SoftmaxTrees.load(path) if path_exists(f"{path}/trees") else PipelineModel.load(path)


def round_losses(model: Model, splits: dict[str, DataFrame], label: str = "state") -> DataFrame:
    """Losses after every boosting round and split.

    Of softmax trees: ``step``, the log ``loss`` of all classes and the ``error`` rate, from one pass
    over a split. Of Spark ML's boosted trees see ``ensemble_losses``.
    """
    if not isinstance(model, SoftmaxTrees):
        return ensemble_losses(model, splits, label)
    found = []
    for split, rows in splits.items():
        chosen = with_label(rows, label).select(*[f"`{name}`" for name in model.columns], F.col("label").cast("int").alias("__label"))

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                y = np.asarray(batch.column("__label"))
                sums = []
                for margin in model.steps(model.values(batch)):
                    top = margin.max(axis=1)
                    own = np.log(np.exp(margin - top[:, None]).sum(axis=1)) + top - margin[np.arange(len(y)), y]
                    sums.append((own.sum(), (margin.argmax(axis=1) != y).sum(), len(y)))
                loss, wrong, n = (np.array(x, float) for x in zip(*sums, strict=True))
                columns = [pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(loss), pa.array(wrong), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["step", "loss", "wrong", "n"])

        sums = chosen.mapInArrow(measure, "step int, loss double, wrong double, n double").groupBy("step")
        sums = sums.agg((F.sum("loss") / F.sum("n")).alias("loss"), (F.sum("wrong") / F.sum("n")).alias("error"))
        found.append(sums.select(F.lit(split).alias("split"), "step", "loss", "error"))
    return reduce(DataFrame.unionByName, found)


def ensemble_losses(model: PipelineModel, splits: dict[str, DataFrame], label: str = "state") -> DataFrame:
    """Log loss after every boosting round and split: of each class against the rest, and of all classes.

    ``class`` is null for the loss of all classes, whose probabilities are those of the
    single ensembles scaled to 1. Every tree scores the rows of a split in one pass.
    """
    vectors, ensembles = model.stages
    rounds = len(ensembles.models[0].trees)
    found = []
    for split, rows in splits.items():
        scored = vectors.transform(with_label(rows, label)).select("features", "label")
        margins: list[list[Column]] = []
        for code, ensemble in enumerate(ensembles.models):
            upto = F.lit(0.0)
            own = []
            for step, (tree, weight) in enumerate(zip(ensemble.trees, ensemble.treeWeights, strict=True)):
                name = f"_{code}_{step}"
                scored = tree.setFeaturesCol("features").setPredictionCol(name).transform(scored)
                upto = upto + F.col(name) * float(weight)
                own.append(upto)
            margins.append(own)
        losses = []
        for step in range(rounds):
            chances = [1 / (1 + F.exp(-2 * own[step])) for own in margins]
            whole = reduce(lambda x, y: x + y, chances)
            of_label = F.lit(None).cast("double")
            for code, own in enumerate(margins):
                sign = F.when(F.col("label") == code, 1.0).otherwise(-1.0)
                losses.append((code, step, F.avg(2 * F.log1p(F.exp(-2 * sign * own[step])))))
                of_label = F.when(F.col("label") == code, chances[code]).otherwise(of_label)
            losses.append((None, step, F.avg(-F.log(of_label / whole))))
        row = scored.agg(*[loss.alias(f"l{k}") for k, (_, _, loss) in enumerate(losses)])
        each = F.array(
            *[F.struct(F.lit(code).cast("int").alias("class"), F.lit(step).alias("step"), F.col(f"l{k}").alias("loss"))
              for k, (code, step, _) in enumerate(losses)]
        )
        found.append(row.select(F.lit(split).alias("split"), F.inline(each)))
    return reduce(DataFrame.unionByName, found)
