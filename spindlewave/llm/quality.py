"""Quality of documents: histogram gradient-boosted trees over statistics of whole texts.

Statistics are computed on arrays of many texts in each task. The trees are grown on a
bounded sample of labelled documents and flattened into arrays, one complete binary
tree a row, which numpy walks for all texts and trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.llm.common import hashed_sample, opened, runs, shared, stored, utf8
from spindlewave.llm.shingles import sets_of, sorted_within, words

RUN = 1 << 18  # bytes of text handled at once
SAMPLE = 20_000  # labelled documents that trees are grown on
TREES, DEPTH, BINS, RATE, RIDGE, LEAST = 80, 4, 64, 0.15, 1.0, 5
FOLDS = 5  # labels are learned from the documents whose checksum modulo this is not 0

UPPER, LOWER, DIGIT, BLANK, LINE, MARK, SIGN, FAR, REST = range(9)


def _classes() -> np.ndarray:
    found = np.full(256, REST, np.uint8)
    found[ord("A") : ord("Z") + 1] = UPPER
    found[ord("a") : ord("z") + 1] = LOWER
    found[ord("0") : ord("9") + 1] = DIGIT
    found[[32, 9, 13]] = BLANK
    found[10] = LINE
    found[list(b".,;:?'\"()-")] = MARK
    found[list(b"!#$%&*+/<=>@[\\]^_`{|}~")] = SIGN
    found[128:] = FAR
    return found


CLASS = _classes()
STATISTICS = (
    "log_bytes", "log_words", "log_lines", "word_length", "longest_share", "words_a_line",
    "upper", "digit", "blank", "mark", "sign", "far", "rest", "words_ended_by_sign", "words_all_upper_start",
    "distinct_words", "distinct_pairs", "repeated_next", "top_word", "bar", "stops", "sign_kinds",
)


def statistics(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text; shares of nothing are 0."""
    n = len(starts) - 1
    size = np.diff(starts).astype(float)
    kind = CLASS[data]

    filled = np.flatnonzero(size > 0)

    def per_text(flags: np.ndarray) -> np.ndarray:
        found = np.zeros(n)
        if len(filled):
            found[filled] = np.add.reduceat(flags, starts[filled], dtype=np.int32)
        return found

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(b > 0, a / np.maximum(b, 1), 0.0)

    kinds = [per_text(kind == k) for k in range(9)]
    hashes, owner = words(data, starts)
    count = np.bincount(owner, minlength=n).astype(float)
    inside = size - kinds[BLANK] - kinds[LINE]
    lines = kinds[LINE] + (size > 0)

    space = (kind == BLANK) | (kind == LINE)
    last = ~space
    last[:-1] &= space[1:]
    if len(data):
        last[starts[1:][size > 0] - 1] = ~space[starts[1:][size > 0] - 1]
    first = ~space
    first[1:] &= space[:-1]
    if len(data):
        first[starts[:-1][size > 0]] = ~space[starts[:-1][size > 0]]
    same_next = np.zeros(len(hashes))
    if len(hashes) > 1:
        same_next[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])

    _, pair_cut = sets_of(hashes, owner, n, 2)
    # How often a text's commonest word occurs: runs of equal hashes within each text.
    begin = np.flatnonzero(sorted_within(hashes, owner, n))
    distinct = np.bincount(owner[begin], minlength=n)
    commonest = np.zeros(n)
    np.maximum.at(commonest, owner[begin], np.diff(np.append(begin, len(hashes))))
    begins, ends = np.flatnonzero(first), np.flatnonzero(last)
    longest = np.zeros(n)
    if len(begins):
        text = np.searchsorted(starts, begins, "right") - 1
        np.maximum.at(longest, text, (ends - begins + 1).astype(float))
    kinds_of_sign = np.zeros(n)
    for sign in b"!#$%&*|":
        kinds_of_sign += per_text(data == sign) > 0

    columns = [
        np.log1p(size), np.log1p(count), np.log1p(lines), share(inside, count), share(longest, inside), share(count, lines),
        share(kinds[UPPER], inside), share(kinds[DIGIT], inside), share(kinds[BLANK], size), share(kinds[MARK], inside),
        share(kinds[SIGN], inside), share(kinds[FAR], inside), share(kinds[REST], inside),
        share(per_text(last & (kind == SIGN)), count), share(per_text(first & (kind == UPPER)), count),
        share(distinct, count), share(np.diff(pair_cut), count),
        share(np.bincount(owner, weights=same_next, minlength=n), count), share(commonest, count),
        share(per_text(data == ord("|")), inside), share(per_text(data == ord(".")), count), kinds_of_sign,
    ]
    return np.stack(columns, axis=1) if n else np.zeros((0, len(STATISTICS)))


def text_statistics(column: pa.Array) -> np.ndarray:
    """STATISTICS of a column of texts; null is empty."""
    data, starts = utf8(column)
    found = [statistics(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]) for a, b in runs(starts, RUN)]
    return np.concatenate([np.zeros((0, len(STATISTICS))), *found])


@dataclass
class Trees:
    """Complete binary trees: node i has the children 2 i + 1 and 2 i + 2."""

    column: np.ndarray  # [trees, inner nodes]
    border: np.ndarray  # [trees, inner nodes]; larger values go right
    value: np.ndarray  # [trees, leaves]
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row: all trees walked at once, level by level."""
        total = np.full(len(x), self.base)
        trees = np.arange(len(self.column))
        if len(trees):
            node = np.zeros((len(x), len(trees)), np.int64)
            rows = np.arange(len(x))[:, None]
            inner = self.column.shape[1]
            while node.size and node[0, 0] < inner:
                right = x[rows, self.column[trees, node]] > self.border[trees, node]
                node = 2 * node + 1 + right
            total += self.value[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Logistic boosting with second-order gains on histograms of quantile bins.

    Without examples the score is 0.5; with one label only it is that label's share,
    smoothed by one example of either.
    """
    positive, n = float(y.sum()), len(y)
    base = float(np.log((positive + 1) / (n - positive + 1)))
    inner, features = 2**depth - 1, x.shape[1]
    found = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    if not 0 < positive < n:
        return found
    borders = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(b, x[:, f], "left") for f, b in enumerate(borders)], axis=1)
    margin = np.full(n, base)
    columns, limits, values = [], [], []
    flat = binned + np.arange(features) * BINS
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        column, border = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            place = ((node - first)[:, None] * (features * BINS) + flat).ravel()
            shape = (width, features, BINS)
            g, h, k = (
                np.bincount(place, np.repeat(v, features), width * features * BINS).reshape(shape)
                for v in (gradient, weight, np.ones(n))
            )
            gl, hl, kl = (np.cumsum(v, axis=2)[:, :, :-1] for v in (g, h, k))
            gt, ht, kt = (v[:, :1].sum(axis=2, keepdims=True) for v in (g, h, k))
            gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
            gain = np.where((kl >= LEAST) & (kt - kl >= LEAST), gain, 0.0).reshape(width, -1)
            best = gain.argmax(axis=1)
            for at in range(width):
                f, b = divmod(int(best[at]), BINS - 1)
                if gain[at, best[at]] > 1e-6 and b < len(borders[f]):
                    column[first + at], border[first + at] = f, borders[f][b]
            chosen = column[node]
            right = x[np.arange(n), chosen] > border[node]
            node = 2 * node + 1 + right
        leaf = node - inner
        g, h = (np.bincount(leaf, v, inner + 1) for v in (gradient, weight))
        value = -RATE * g / (h + RIDGE)
        margin += value[leaf]
        columns.append(column)
        limits.append(border)
        values.append(value)
    return Trees(np.stack(columns), np.stack(limits), np.stack(values), base)


def fold(doc_id: str | Column = "doc_id") -> Column:
    """The fold of a document: crc32 of its id as text, modulo FOLDS; without an id 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Grow trees on at most ``sample`` labelled documents outside fold 0, the first by hash.

    Labels other than 0 and 1 and labels without a document are left out; a document
    with several labels is an example of each; rows that share an id share the labels.
    """
    chosen = labels.select(F.col("doc_id").alias("of"), F.col("quality").cast("int").alias("label"))
    chosen = chosen.where(F.col("label").isin(0, 1) & F.col("of").isNotNull() & (fold("of") != 0))
    chosen = hashed_sample(chosen, ["of", "label"], sample)
    # The sample is bounded, so it can go to every executor.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).select("text", "label")
    schema = "label int, x array<double>"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_statistics(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), lists], ["label", "x"])

    examples = stored(rows.mapInArrow(measure, schema), "examples")
    found = hashed_sample(examples, ["x", "label"], 2 * sample).toArrow()
    y = np.asarray(found.column("label")).astype(float)
    x = np.asarray(found.column("x").combine_chunks().values) if found.num_rows else np.zeros(0)
    return grow(x.reshape(-1, len(STATISTICS)), y)


def scored(docs: DataFrame, trees: Trees, threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id if not given), then score and predicted, for every row.

    A null or empty text is scored by the statistics of an empty text. Columns of
    ``keep`` named score or predicted are replaced.
    """
    keep = [name for name in (keep or ["doc_id"]) if name not in ("score", "predicted")]
    sent = shared(docs.sparkSession, trees)
    fields = [docs.schema[name] for name in keep]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = opened(sent)
        for batch in batches:
            found = known.scores(text_statistics(batch.column("text")))
            columns = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found), pa.array((found >= threshold).astype(np.int32))], [*keep, "score", "predicted"]
            )

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(score, schema)
