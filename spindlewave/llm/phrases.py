"""Collocations by a suffix tree of words, cut off at three words and built in parts.

1. Words are counted per language. A word's key is a hash of language and word; two words
   with one key fail the job.
2. Vertical partitioning: a prefix is a word; a word with more occurrences than the budget
   is extended, and its phrases of two and of three words are prefixes of their own. Prefixes are
   dealt into groups that hold half the budget of suffixes on average.
3. Each task cuts the suffixes of its texts off at three words, or before a word too rare for any
   phrase, and sends every group the tree of those it has found, with counts.
4. Each group's subtrees are put together by themselves, in bounded memory; how often a phrase
   occurs is the total of the leaves below its node.

A phrase's score, its cut and what drops it are computed from these counts in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindlewave.llm.common import mix, runs, stored, utf8
from spindlewave.llm.shingles import GOLDEN
from spindlewave.llm.spans import LOWER, Hashes, spans

RUN = 1 << 19  # bytes of text handled at once
BUDGET = 1 << 20  # suffixes a group of prefixes may hold
HOT_MOST = 100_000  # words over the budget, at most: beyond that many the budget grows
FLUSH = 1 << 20  # suffixes that a task holds before it sends their tree
WORDS, LETTERS = 1 << 18, 1 << 25  # different words, and bytes of them, that a task holds before it sends their counts
PARTS = 64  # of a language, in which its first phrases are found before they meet
BITS = 26  # the bitmap of words that may stand in a phrase has 2 ** BITS bits (8 MB)

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True

NONE, PAIR = np.uint64(0), np.uint64(1)  # no third word, and the total of a pair


def _marks(data: np.ndarray) -> np.ndarray:
    return ~(BLANK | BREAK)[data]


def parts(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Texts in parts of about RUN bytes: the first text's number, bytes, starts, and the bytes that are its own.

    A longer text is cut where a word ends; the part then goes on for two more words,
    which belong to the next part but end phrases of this one.
    """
    for a, b in runs(starts, RUN):
        part = data[starts[a] : starts[b]]
        if len(part) <= 2 * RUN:
            yield a, part, starts[a : b + 1] - starts[a], len(part)
            continue
        # Only a single text is that long.
        at = 0
        while at < len(part):
            end = _word_ends(part, at + RUN, 1)
            reach = _word_ends(part, end, 2)
            yield a, part[at:reach], np.array([0, reach - at]), end - at
            at = end


def _word_ends(part: np.ndarray, at: int, number: int) -> int:
    """The end of the word at or the ``number``-th one that begins behind ``at``; the end of the text without one."""
    width = 1 << 10
    while at + width < len(part):
        inside = _marks(part[at : at + width])
        ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        if not inside[0] and number == 1:
            return at
        if len(ends) >= number:
            return at + int(ends[number - 1])
        width *= 4
    return len(part)


def words_of(data: np.ndarray, starts: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where words begin and end, their texts, keys, and whether the next word stands in the same piece."""
    first, last = spans(_marks(data), starts)
    owner = np.searchsorted(starts, first, "right") - 1
    keys = mix(Hashes(data).of(first, last) ^ lang[owner])
    keys = np.where(keys < 2, keys + np.uint64(2), keys)
    upto = np.cumsum(BREAK[data])[first] if len(first) else first
    joined = np.zeros(len(first), bool)
    joined[:-1] = (owner[1:] == owner[:-1]) & (upto[1:] == upto[:-1])
    return first, last, owner, keys, joined


def languages(column: pa.Array) -> np.ndarray:
    """A 64-bit number for the language of every row."""
    coded = column.dictionary_encode()
    known = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in coded.dictionary.to_pylist()]
    return np.array([*known, 0], np.uint64)[np.asarray(coded.indices.fill_null(len(known)))]


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def word_counts(docs: DataFrame) -> DataFrame:
    """key, lang, word and f for every word of every language; stored."""
    schema = "key long, lang string, word string, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # key -> language, word, occurrences
        letters = 0

        def out() -> pa.RecordBatch:
            names = [x[0] for x in held.values()], [x[1] for x in held.values()], [x[2] for x in held.values()]
            keys = np.fromiter(held, np.uint64, len(held)).view(np.int64)
            arrays = [pa.array(keys), pa.array(names[0], pa.string()), pa.array(names[1], pa.string()), pa.array(names[2], pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, ["key", "lang", "word", "n"])

        for batch in batches:
            data, starts = utf8(batch.column("text"))
            number, names = languages(batch.column("lang")), batch.column("lang")
            for a, part, cut, own in parts(data, starts):
                first, last, owner, keys, _ = words_of(part, cut, number[a : a + len(cut) - 1])
                mine = first < own
                found, at, n = np.unique(keys[mine], return_index=True, return_counts=True)
                small = LOWER[part]
                for key, place, more in zip(found.tolist(), at.tolist(), n.tolist(), strict=True):
                    known = held.get(key)
                    if known is None:
                        word = small[first[place] : last[place]].tobytes().decode()
                        held[key] = [names[a + int(owner[place])].as_py(), word, more]
                        letters += len(word)
                    else:
                        known[2] += more
                if len(held) >= WORDS or letters >= LETTERS:
                    yield out()
                    letters = 0
        if held:
            yield out()

    rows = texts(docs).mapInArrow(count, schema)
    return stored(rows.groupBy("key", "lang", "word").agg(F.sum("n").alias("f")), "words")


def bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the bits of all keys set."""
    slot = F.col("key").bitwiseAND((1 << BITS) - 1)
    marks = keys.select(F.shiftright(slot, 6).alias("word"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("bit"))
    marks = marks.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    found = np.zeros(1 << (BITS - 6), np.int64)
    found[marks["word"].to_numpy(np.int64)] = marks["bits"].to_numpy(np.int64)
    return found


def tree(suffixes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different suffixes [k, 3] in order, and how often each occurs."""
    order = np.lexsort((suffixes[:, 2], suffixes[:, 1], suffixes[:, 0]))
    suffixes, n = suffixes[order], n[order]
    fresh = np.ones(len(suffixes), bool)
    fresh[1:] = (suffixes[1:] != suffixes[:-1]).any(axis=1)
    at = np.flatnonzero(fresh)
    return suffixes[at], np.add.reduceat(n, at) if len(at) else n


def group_of(suffixes: np.ndarray, hot: np.ndarray, groups: int) -> np.ndarray:
    """The group of each suffix, from its prefix: its first word, or all of it where that one is hot."""
    prefix = suffixes[:, 0].copy()
    long = np.isin(prefix, hot)
    prefix[long] = mix(mix(prefix[long] * GOLDEN + suffixes[long, 1]) * GOLDEN + suffixes[long, 2])
    return (mix(prefix) % np.uint64(groups)).astype(np.int32)


LEVELS = ("h1", "c1", "h2", "c2", "h3", "n")


def as_levels(suffixes: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Sorted suffixes as a tree, level by level: keys, and the number of children or the occurrences."""
    one, two = np.ones(len(n), bool), np.ones(len(n), bool)
    one[1:] = suffixes[1:, 0] != suffixes[:-1, 0]
    two[1:] = one[1:] | (suffixes[1:, 1] != suffixes[:-1, 1])
    at1, at2 = np.flatnonzero(one), np.flatnonzero(two)
    below = np.diff(np.append(np.searchsorted(at2, at1), len(at2)))
    leaves = np.diff(np.append(at2, len(n)))
    return [
        x.tobytes() for x in (
            suffixes[at1, 0], below.astype(np.uint32), suffixes[at2, 1], leaves.astype(np.uint32),
            suffixes[:, 2], n.astype(np.int64) if n.max(initial=0) >= 1 << 32 else n.astype(np.uint32),
        )
    ]


def from_levels(levels: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    h1, h2, h3 = (np.frombuffer(levels[i], np.uint64) for i in (0, 2, 4))
    c1, c2 = (np.frombuffer(levels[i], np.uint32) for i in (1, 3))
    n = np.frombuffer(levels[5], np.int64 if len(levels[5]) == 8 * len(h3) else np.uint32).astype(np.int64)
    two = np.repeat(h1, c1)
    return np.stack([np.repeat(two, c2), np.repeat(h2, c2), h3], axis=1), n


def subtrees(docs: DataFrame, kept: np.ndarray, hot: np.ndarray, groups: int) -> DataFrame:
    """group and the levels of the tree of those of a task's suffixes that belong to it."""
    shared = docs.sparkSession.sparkContext.broadcast((kept, hot))

    def cut(keys: np.ndarray, joined: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes of two or three words, those of hot words also as a pair."""
        bits, hot = shared.value
        slot = (keys & np.uint64((1 << BITS) - 1)).astype(np.int64)
        good = ((bits[slot >> 6] >> (slot & 63)) & 1).astype(bool)
        second = np.zeros(len(keys), bool)
        second[:-1] = joined[:-1] & good[:-1] & good[1:]
        third = np.zeros(len(keys), bool)
        third[:-1] = second[:-1] & second[1:]
        at = np.flatnonzero(second[:own])
        found = np.stack([keys[at], keys[at + 1], np.where(third[at], keys[np.minimum(at + 2, len(keys) - 1)], NONE)], axis=1)
        over = np.isin(found[:, 0], hot)
        if over.any():
            pairs = found[over].copy()
            pairs[:, 2] = PAIR
            found = np.concatenate([found[~over | (found[:, 2] != NONE)], pairs])
        return found

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            every = np.concatenate(held)
            suffixes, n = tree(every, np.ones(len(every), np.int64))
            group = group_of(suffixes, shared.value[1], groups)
            order = np.argsort(group, kind="stable")
            suffixes, n, group = suffixes[order], n[order], group[order]
            ends = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            rows = [as_levels(suffixes[x:y], n[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)]
            columns = [pa.array([row[k] for row in rows], pa.binary()) for k in range(len(LEVELS))]
            return pa.RecordBatch.from_arrays([pa.array(group[ends[:-1]]), *columns], ["group", *LEVELS])

        for batch in batches:
            data, starts = utf8(batch.column("text"))
            number = languages(batch.column("lang"))
            for a, part, where, own in parts(data, starts):
                first, _, _, keys, joined = words_of(part, where, number[a : a + len(where) - 1])
                found = cut(keys, joined, int(np.searchsorted(first, own)))
                if len(found):
                    held.append(found)
                    size += len(found)
                if size >= FLUSH:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    columns = ", ".join(f"{name} binary" for name in LEVELS)
    return texts(docs).mapInArrow(build, f"group int, {columns}")


def phrase_counts(trees: DataFrame, hot: np.ndarray, least: int) -> DataFrame:
    """h1, h2, h3 (null for a pair) and f of the phrases with at least ``least`` occurrences."""
    shared = trees.sparkSession.sparkContext.broadcast(hot)
    names = ("h1", "h2", "h3", "f")

    def nodes(shards: list) -> pa.RecordBatch:
        found = [from_levels(x) for x in shards]
        suffixes, n = tree(np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))
        # The total of a pair is that of its leaves, but for hot words, whose pairs have come with theirs.
        split = np.isin(suffixes[:, 0], shared.value)
        pair = np.ones(len(n), bool)
        pair[1:] = (suffixes[1:, :2] != suffixes[:-1, :2]).any(axis=1)
        at = np.flatnonzero(pair)
        own = np.where(split & (suffixes[:, 2] != PAIR), 0, n)
        totals = np.add.reduceat(own, at) if len(at) else own
        two = at[totals >= least]
        three = np.flatnonzero((suffixes[:, 2] > PAIR) & (n >= least))
        keys = np.concatenate([suffixes[two], suffixes[three]]).view(np.int64)
        f = np.concatenate([totals[totals >= least], n[three]])
        short = np.arange(len(f)) < len(two)
        arrays = [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(keys[:, 2], mask=short), pa.array(f)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, shards = None, []
        for batch in batches:
            columns = [batch.column(name) for name in LEVELS]
            for k, own in enumerate(batch.column("group").to_pylist()):
                if own != group and shards:
                    yield nodes(shards)
                    shards = []
                group = own
                shards.append([column[k].as_py() for column in columns])
        if shards:
            yield nodes(shards)

    dealt = trees.repartition("group").sortWithinPartitions("group")
    return dealt.mapInArrow(merge, "h1 long, h2 long, h3 long, f long")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exactly."""
    whole = [c.cast("decimal(19,0)") for c in (a, left, right)]
    over = (whole[0] * whole[0]).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", over, (whole[1] * whole[2]).cast("decimal(38,0)"))


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, cover: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` phrases of each language.

    A null language is ``und``, a null text empty. A phrase of two or three words of a piece
    counts with all its occurrences, overlaps included; it is a candidate with ``least`` of
    them, and dropped if a longer candidate that holds it has ``cover`` percent of its
    occurrences. A text's rows are all counted, repeated ones too. Without words there
    are no rows. Other columns are not read.
    """
    words = word_counts(docs)
    if not words.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError("two words have one key")
    totals = words.groupBy(F.col("lang").alias("of_lang")).agg(F.sum("f").alias("n"))
    kept = words.where(F.col("f") >= least)
    total = words.agg(F.sum("f")).first()[0] or 0
    budget = max(BUDGET, total // HOT_MOST)
    # Fewer than HOT_MOST words are over the budget.
    hot = np.array([row[0] for row in kept.where(F.col("f") > budget).select("key").collect()], np.int64).view(np.uint64)
    trees = subtrees(docs, bitmap(kept), hot, max(1, -(-2 * total // budget)))
    counts = stored(phrase_counts(trees, hot, least), "phrases")

    def named(k: int) -> DataFrame:
        return kept.select(F.col("key").alias(f"k{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"))

    pairs, triples = counts.where("h3 is null").drop("h3"), counts.where("h3 is not null")
    first = kept.select(F.col("key").alias("k1"), "lang", F.col("word").alias("w1"), F.col("f").alias("f1"))
    two = pairs.join(first, F.col("h1") == F.col("k1")).join(named(2), F.col("h2") == F.col("k2"))
    longer = triples.select("h1", "h2", "f").union(triples.select("h2", "h3", "f"))
    longer = longer.groupBy("h1", "h2").agg(F.max("f").alias("longest")).toDF("x1", "x2", "longest")
    two = two.join(longer, (F.col("h1") == F.col("x1")) & (F.col("h2") == F.col("x2")), "left")
    two = two.where(F.col("longest").isNull() | (100 * F.col("longest") < cover * F.col("f")))
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"))
    two = two.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))

    three = triples.join(first, F.col("h1") == F.col("k1")).join(named(2), F.col("h2") == F.col("k2"))
    three = three.join(named(3), F.col("h3") == F.col("k3"))
    three = three.join(pairs.toDF("x1", "x2", "f12"), (F.col("h1") == F.col("x1")) & (F.col("h2") == F.col("x2")))
    three = three.join(pairs.toDF("y2", "y3", "f23"), (F.col("h2") == F.col("y2")) & (F.col("h3") == F.col("y3")))
    a = F.col("f")
    three = three.withColumn("s1", score(a, F.col("f1"), F.col("f23"))).withColumn("s2", score(a, F.col("f12"), F.col("f3")))
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), a.alias("a"),
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    scored = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = (F.desc("score"), F.desc("a"), "phrase")
    own = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*first))
    some = scored.withColumn("own", own).where(F.col("own") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*first))).where(F.col("rank") <= top)
    found = ranked.join(totals, F.col("lang") == F.col("of_lang"))
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return found.select(*[F.col(x) if x in ("lang", "phrase") else F.col(x).cast("long").alias(x) for x in columns])
