"""Predictions from a local model and from a remote one."""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.functions.states import state_label
from spindlewave.model.trees import SoftmaxTrees
from spindlewave.schema import PIVOT_FEATURES

NO_REPLY = -1

# Request text in, reply text (or nothing) out.
Transport = Callable[[str], "str | None"]


def predict(model: PipelineModel | SoftmaxTrees, rows: DataFrame) -> DataFrame:
    """Feature rows with ``predicted_code`` and ``predicted_state``.

    Softmax trees are expressions here, so they score a stream as they score a table.
    """
    added = ("features", "rawPrediction", "probability", "prediction")
    code = F.col("prediction").cast("int")
    return (
        model.transform(rows)
        .withColumn("predicted_code", code)
        .withColumn("predicted_state", state_label(code))
        .drop(*added)
    )


def request_frame(columns: Sequence[str]) -> tuple[str, str]:
    """What stands before and behind the rows of a request: ``{"columns": [...], "data": [``, ``]}``."""
    return f'{{"columns":{json.dumps(list(columns))},"data":[', "]}"


def request_row(columns: Sequence[str] = PIVOT_FEATURES) -> Column:
    """The numbers of a row as JSON; a missing one, or one that JSON cannot hold, is ``null``."""

    def finite(number: Column) -> Column:
        endless = F.isnan(number) | (F.abs(number) == float("inf"))
        return F.when(~endless, number)

    return F.to_json(F.array(*[finite(F.col(name).cast("double")) for name in columns]))


def request_payload(columns: Sequence[str] = PIVOT_FEATURES) -> Column:
    """The JSON request for one row."""
    head, tail = request_frame(columns)
    return F.concat(F.lit(head), request_row(columns), F.lit(tail))


def reply_code(reply: Column) -> Column:
    """The class code in the reply to a row, such as ``[2.0]``; -1 without a reply, NULL if unreadable."""
    number = F.translate(reply, "[] ", "").try_cast("float")
    return F.when(reply.isNull(), F.lit(NO_REPLY)).otherwise(number.cast("int"))


class HttpTransport:
    """Posts requests to a model server."""

    def __init__(self, url: str, timeout: float = 10.0):
        self.url = url
        self.timeout = timeout

    def __call__(self, text: str) -> str | None:
        headers = {"Content-Type": "application/json; charset=utf-8", "Accept": "application/json"}
        request = Request(self.url, data=text.encode("utf-8"), headers=headers)
        with urlopen(request, timeout=self.timeout) as reply:
            return reply.read().decode("utf-8") or None


def score_remote(
    rows: DataFrame,
    transport: Transport,
    columns: Sequence[str] = PIVOT_FEATURES,
    rows_per_request: int = 1000,
    in_flight: int = 4,
    retries: int = 2,
    back_off: float = 0.2,
) -> DataFrame:
    """Feature rows with ``remote_code``, ``remote_error`` and ``remote_state``.

    Many rows go into one request, and a task has at most ``in_flight`` requests under way;
    rows keep their order. A request whose transport fails is sent again up to ``retries`` times, after
    ``back_off`` seconds and twice as many each further time. If it fails for good, or a reply has
    another number of predictions than the request has rows, its rows are left without a
    code, with an empty state and the error text; so is a row whose prediction is
    unreadable. Any other error fails the job.
    """
    if in_flight < 1 or retries < 0:
        raise ValueError("at least one request is in flight, and retries are not negative")
    head, tail = request_frame(columns)
    sent = rows.withColumn("_request", request_row(columns))
    texts = ("_reply", "remote_error")
    schema = T.StructType([*sent.schema.fields, *[T.StructField(name, T.StringType()) for name in texts]])

    def send(text: str) -> str | None:
        for again in range(retries + 1):
            try:
                return transport(text)
            except OSError:  # refused and broken connections, timeouts, HTTP errors
                if again == retries:
                    raise
                time.sleep(back_off * 2**again)

    def answer(part: pa.RecordBatch) -> pa.RecordBatch:
        replies, error = [None] * len(part), None
        try:
            reply = send(head + ",".join(part.column("_request").to_pylist()) + tail)
        except OSError as failure:
            error = f"{type(failure).__name__}: {failure}"
        else:
            found = reply.split(",") if reply else replies
            if len(found) == len(part):
                replies = found
            else:
                error = f"{len(found)} predictions for {len(part)} rows"
        added = [pa.array(replies, pa.string()), pa.array([error] * len(part), pa.string())]
        return pa.RecordBatch.from_arrays([*part.columns, *added], schema.fieldNames())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        under_way: deque = deque()
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                for start in range(0, len(batch), rows_per_request):
                    under_way.append(pool.submit(answer, batch.slice(start, rows_per_request)))
                    if len(under_way) == in_flight:
                        yield under_way.popleft().result()
            while under_way:
                yield under_way.popleft().result()

    asked = sent.mapInArrow(ask, schema)
    code = F.when(F.col("remote_error").isNull(), reply_code(F.col("_reply")))
    unreadable = F.when(F.col("remote_code").isNull(), F.concat(F.lit("unreadable: "), F.col("_reply")))
    state = F.when(F.col("remote_code").isNull(), F.lit("")).otherwise(state_label(F.col("remote_code")))
    return asked.withColumn("remote_code", code).select(
        *rows.columns, "remote_code", F.coalesce("remote_error", unreadable).alias("remote_error"), state.alias("remote_state")
    )


def agreement(predictions: DataFrame) -> DataFrame:
    """How often local prediction, remote prediction and original state go together."""
    return predictions.groupBy("state", "predicted_state", "remote_state").agg(
        F.count(F.lit(1)).alias("n")
    )
