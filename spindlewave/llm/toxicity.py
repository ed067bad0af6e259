"""Toxicity of documents: boosted trees over dense features, with isotonic calibration.

1. A lexicon is learned from labelled documents: words, and stems of some lengths, that
   occur in toxic documents far more often than in others, by the log-odds of their
   document counts over its standard error. Nothing in it is given beforehand.
2. The features of a text are densities of lexicon terms, how many of them stand near a
   second person, and rates of capitals, punctuation and obfuscation (terms that show
   only when signs for letters, signs between letters and drawn-out letters are undone).
3. Trees are grown on features for which a document's own fold took no part in the
   lexicon. Scores of trees that have not seen a fold give the isotonic calibration.

A document is scored from its text alone, in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.llm.common import dropped, hashed_sample, opened, runs, shared, stored, utf8
from spindlewave.llm.quality import FOLDS, Trees, fold, grow
from spindlewave.llm.spans import LOWER, Hashes, spans

RUN = 1 << 18  # bytes of text handled at once
SAMPLE = 20_000  # labelled documents that the model is learned from
LEXICON = 2_000  # terms of a lexicon, those that tell most
SUPPORT = 3  # toxic documents that a term occurs in, at least
CLEAR = 3.0  # log-odds over their standard error, at least
STEMS = (4, 6, 8)  # lengths in bytes of the stems of longer words
TREES, DEPTH = 40, 3
NEAR = 5  # words on either side of a term that a second person is looked for in

# Words for the second person in four languages.
SECOND_PERSON = (
    "you your yours yourself yourselves u ur "
    "du dich dir dein deine deinen deiner deines euch euer eure ihr ihnen sie "
    "tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestro vuestra os"
).split()
# Signs that stand for letters, and the letters.
SIGNS, LETTERS = b"013457@$", b"oieastas"

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
STANDS_FOR = LOWER.copy()
STANDS_FOR[np.frombuffer(SIGNS, np.uint8)] = np.frombuffer(LETTERS, np.uint8)
BETWEEN = np.zeros(256, bool)
BETWEEN[np.frombuffer(b".*_-", np.uint8)] = True

FEATURES = (
    "log_words", "terms", "log_terms", "distinct_terms", "weight", "top_weight", "stems", "stem_weight", "top_stem",
    "near_second_person", "second_person", "obfuscated_terms", "signs_in_words", "drawn_out",
    "capitals", "capital_words", "punctuation", "exclamations", "questions", "repeated_marks",
)


def second_person() -> np.ndarray:
    texts = [word.encode() for word in SECOND_PERSON]
    data = np.frombuffer(b"".join(texts), np.uint8)
    cut = np.cumsum([0, *map(len, texts)])
    return np.sort(np.unique(Hashes(data).of(cut[:-1], cut[1:])))


def plain_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Hashes]:
    """Runs of letters: where they begin and end, the text each belongs to, and hashes of the bytes."""
    first, last = spans(LETTER[data], starts)
    return first, last, np.searchsorted(starts, first, "right") - 1, Hashes(data)


def undone(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with signs for letters, signs between letters and drawn-out letters undone."""
    if not len(data):
        return data, starts
    letter = LETTER[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = letter[:-1], letter[1:]
    # A sign stands for a letter only beside one; "!" for an i only between two.
    found = np.where(before | after, STANDS_FOR[data], LOWER[data])
    found = np.where((data == ord("!")) & before & after, ord("i"), found).astype(np.uint8)
    gone = BETWEEN[data] & before & after
    same = np.zeros(len(data), bool)
    same[1:] = LETTER[found[1:]] & (found[1:] < 128) & (found[1:] == found[:-1])
    # Of three or more equal letters one is left.
    longer = same.copy()
    longer[1:] &= same[:-1]
    run = longer.copy()
    run[:-1] |= longer[1:]
    gone |= run & same
    keep = ~gone
    kept = np.concatenate([[0], np.cumsum(keep)])
    return found[keep], kept[starts]


def terms_of(first: np.ndarray, last: np.ndarray, hashes: Hashes) -> list[np.ndarray]:
    """Hashes of the words, then of their stems of each length, 0 where a word is no longer than that."""
    found = [hashes.of(first, last)]
    for length in STEMS:
        longer = last - first > length
        stem = hashes.of(first, np.where(longer, first + length, last)) + np.uint64(length)
        found.append(np.where(longer, stem, np.uint64(0)))
    return found


@dataclass
class Lexicon:
    """Hashes of terms, sorted, and what each tells."""

    terms: np.ndarray
    weights: np.ndarray

    def weigh(self, hashes: np.ndarray) -> np.ndarray:
        """The weight of each hash; 0 for what is no term."""
        if not len(self.terms):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, self.weights[at], 0.0)


def lexicon(terms: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> Lexicon:
    """The terms whose documents are toxic clearly more often than others, by counts of documents."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    clear = odds / np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    chosen = np.flatnonzero((toxic >= SUPPORT) & (clear >= CLEAR))
    chosen = chosen[np.lexsort((terms[chosen], -clear[chosen]))][:LEXICON]
    chosen = chosen[np.argsort(terms[chosen])]
    return Lexicon(terms[chosen], odds[chosen])


def features(data: np.ndarray, starts: np.ndarray, known: Lexicon) -> np.ndarray:
    """One row of FEATURES per text; rates of nothing are 0."""
    n = len(starts) - 1
    first, last, owner, hashes = plain_words(data, starts)
    count = np.bincount(owner, minlength=n).astype(float)
    size = np.diff(starts).astype(float)
    filled = np.flatnonzero(size > 0)

    def per_text(flags: np.ndarray) -> np.ndarray:
        found = np.zeros(n)
        if len(filled):
            found[filled] = np.add.reduceat(flags, starts[filled], dtype=np.int64)
        return found

    def rate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a / np.maximum(b, 1)

    def summed(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=values, minlength=n)

    words, *stems = terms_of(first, last, hashes)
    weight = known.weigh(words)
    hit = weight > 0
    stem_weight = np.zeros(len(first))
    for stem in stems:
        np.maximum(stem_weight, known.weigh(stem), out=stem_weight)
    either = np.maximum(weight, stem_weight)
    top, top_stem = np.zeros(n), np.zeros(n)
    np.maximum.at(top, owner, weight)
    np.maximum.at(top_stem, owner, stem_weight)
    at = np.flatnonzero(hit)
    pairs = np.unique(np.stack([owner[at].astype(np.uint64), words[at]]), axis=1)
    distinct = np.bincount(pairs[0].astype(np.int64), minlength=n)

    addressed = np.isin(words, second_person())
    upto = np.concatenate([[0], np.cumsum(addressed)])
    bounds = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    place = np.arange(len(first))
    low = np.maximum(place - NEAR, bounds[:-1][owner])
    high = np.minimum(place + NEAR + 1, bounds[1:][owner])
    near = (either > 0) & (upto[high] - upto[low] - addressed > 0)

    clear, cut = undone(data, starts)
    f2, l2, o2, h2 = plain_words(clear, cut)
    shown = np.bincount(o2, weights=known.weigh(h2.of(f2, l2)) > 0, minlength=n)

    letter, upper = LETTER[data], (data >= 65) & (data <= 90)
    mark = (data == ord("!")) | (data == ord("?"))
    again, drawn, inner = (np.zeros(len(data), bool) for _ in range(3))
    again[1:] = mark[1:] & mark[:-1]
    drawn[2:] = letter[2:] & (data[2:] < 128) & (LOWER[data[2:]] == LOWER[data[1:-1]]) & (LOWER[data[2:]] == LOWER[data[:-2]])
    inner[1:-1] = letter[:-2] & letter[2:] & ~letter[1:-1] & ~BLANK[data[1:-1]] & (data[1:-1] != ord("'"))
    capital = np.concatenate([[0], np.cumsum(upper)])
    shouted = (last - first >= 3) & (capital[last] - capital[first] == last - first)
    punctuation = ~letter & ~BLANK[data] & ((data < 48) | (data > 57))

    terms = summed(hit)
    columns = [
        np.log1p(count), rate(terms, count), np.log1p(terms), distinct, rate(summed(weight), count), top,
        rate(summed(stem_weight > 0), count), rate(summed(stem_weight), count), top_stem, rate(summed(near), count),
        rate(summed(addressed), count), np.maximum(shown - terms, 0), rate(per_text(inner), count),
        rate(per_text(drawn), count), rate(per_text(upper), per_text(letter)), rate(summed(shouted), count),
        rate(per_text(punctuation), size), rate(per_text(data == ord("!")), count),
        rate(per_text(data == ord("?")), count), rate(per_text(again), count),
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1) if n else np.zeros((0, len(FEATURES)))


def text_features(column: pa.Array, known: Lexicon) -> np.ndarray:
    """FEATURES of a column of texts; null is empty."""
    data, starts = utf8(column)
    found = [features(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a], known) for a, b in runs(starts, RUN)]
    return np.concatenate([np.zeros((0, len(FEATURES))), *found])


@dataclass
class Isotonic:
    """A rising line through block means, by adjacent pools of violators."""

    at: np.ndarray
    value: np.ndarray

    @classmethod
    def fit(cls, score: np.ndarray, label: np.ndarray) -> Isotonic:
        if not len(score):
            return cls(np.zeros(1), np.full(1, 0.5))
        at, place = np.unique(score, return_inverse=True)
        weight = np.bincount(place).astype(float)
        mean = np.bincount(place, weights=label) / weight
        blocks: list[list[float]] = []  # mean, weight, sum of scores
        for m, w, s in zip(mean, weight, at, strict=True):
            blocks.append([m, w, s * w])
            while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
                m2, w2, s2 = blocks.pop()
                m1, w1, s1 = blocks[-1]
                blocks[-1] = [(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, s1 + s2]
        found = np.array(blocks)
        return cls(found[:, 2] / found[:, 1], found[:, 0])

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.at, self.value)


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    calibration: Isotonic

    def scores(self, column: pa.Array) -> np.ndarray:
        return self.calibration(self.trees.scores(text_features(column, self.lexicon)))


def labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text, label and fold of at most ``sample`` labels outside fold 0, the first by hash."""
    chosen = labels.select(F.col("doc_id").alias("__of"), F.col("toxic").cast("int").alias("__label"))
    chosen = chosen.where(F.col("__label").isin(0, 1) & F.col("__of").isNotNull() & (fold("__of") != 0))
    chosen = hashed_sample(chosen, ["__of", "__label"], sample)
    # The sample is bounded, so it can go to every executor.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__of"))
    return rows.select("text", F.col("__label").alias("label"), fold("__of").cast("int").alias("fold"))


def term_counts(examples: DataFrame) -> DataFrame:
    """term and, by fold and label, in how many documents it occurs (columns n{fold}{label})."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column("text"))
            group = np.asarray(batch.column("fold")) * 2 + np.asarray(batch.column("label"))
            for a, b in runs(starts, RUN):
                first, last, owner, hashes = plain_words(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                found = np.concatenate(terms_of(first, last, hashes))
                owner = np.tile(owner, len(STEMS) + 1)
                there = np.flatnonzero(found)
                pairs = np.unique(np.stack([owner[there].astype(np.uint64), found[there]]), axis=1)
                of = group[a:b][pairs[0].astype(np.int64)].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[1].view(np.int64)), pa.array(of)], ["term", "of"])

    rows = examples.mapInArrow(count, "term long, of int")
    sums = [F.count_if(F.col("of") == f * 2 + y).alias(f"n{f}{y}") for f in range(1, FOLDS) for y in (0, 1)]
    return rows.groupBy("term").agg(*sums)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon, trees and calibration from at most ``sample`` labelled documents outside fold 0.

    Labels other than 0 and 1 and labels without a document are left out; a document
    with several labels is an example of each; rows that share an id share the labels.
    Without labels every score is 0.5.
    """
    examples = stored(labelled(docs, labels, sample), "toxic-examples")
    totals = np.zeros((FOLDS, 2))
    for f, y, n in examples.groupBy("fold", "label").agg(F.count(F.lit(1))).collect():
        totals[f, y] = n
    toxic = sum(F.col(f"n{f}1") for f in range(1, FOLDS))
    clean = sum(F.col(f"n{f}0") for f in range(1, FOLDS))
    odds = F.log((toxic + 0.5) / (totals[:, 1].sum() + 1)) - F.log((clean + 0.5) / (totals[:, 0].sum() + 1))
    clear = odds / F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    best = term_counts(examples).where((toxic >= SUPPORT) & (clear >= CLEAR)).orderBy(clear.desc(), "term").limit(2 * LEXICON)
    counts = best.toArrow()
    terms = np.asarray(counts.column("term").combine_chunks()).view(np.uint64)
    by = np.stack([
        np.stack([np.asarray(counts.column(f"n{f}{y}").combine_chunks()).astype(float) for y in (0, 1)])
        if f else np.zeros((2, len(terms))) for f in range(FOLDS)
    ])

    def without(own: int) -> Lexicon:
        others = [f for f in range(1, FOLDS) if f != own]
        own_counts, own_totals = by[others].sum(axis=0), totals[others].sum(axis=0)
        return lexicon(terms, own_counts[1], own_counts[0], own_totals[1], own_totals[0])

    known = [without(f) for f in range(FOLDS)]
    lexicons_of = shared(docs.sparkSession, known)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicons = opened(lexicons_of)
        for batch in batches:
            of = np.asarray(batch.column("fold"))
            x = np.zeros((len(batch), len(FEATURES)))
            for f in np.unique(of):
                at = np.flatnonzero(of == f)
                x[at] = text_features(batch.column("text").take(pa.array(at)), lexicons[f])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("fold"), lists], ["label", "fold", "x"])

    measured = stored(examples.mapInArrow(measure, "label int, fold int, x array<double>"), "toxic-features")
    found = hashed_sample(measured, ["x", "label", "fold"], 2 * sample).toArrow()
    dropped(examples, measured)
    y = np.asarray(found.column("label")).astype(float)
    of = np.asarray(found.column("fold"))
    x = np.asarray(found.column("x").combine_chunks().values) if found.num_rows else np.zeros(0)
    x = x.reshape(-1, len(FEATURES))
    unseen = np.zeros(len(y))
    for f in np.unique(of):
        unseen[of == f] = grow(x[of != f], y[of != f], TREES, DEPTH).scores(x[of == f])
    return Model(known[0], grow(x, y, TREES, DEPTH), Isotonic.fit(unseen, y))


def scored(docs: DataFrame, model: Model, threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id if not given), then score and predicted, for every row.

    A null or empty text is scored by the features of an empty text. Columns of
    ``keep`` named score or predicted are replaced.
    """
    keep = [name for name in (keep or ["doc_id"]) if name not in ("score", "predicted")]
    sent = shared(docs.sparkSession, model)
    fields = [docs.schema[name] for name in keep]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = opened(sent)
        for batch in batches:
            found = known.scores(batch.column("text"))
            columns = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found), pa.array((found >= threshold).astype(np.int32))], [*keep, "score", "predicted"]
            )

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(score, schema)
