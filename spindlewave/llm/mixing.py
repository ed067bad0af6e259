"""Mixing sources to target weights: iterative proportional fitting, then sampling.

Everything runs as DataFrame operations. Documents are counted into cells by source,
language and topic; the cells' token weights are raked until every margin has its
target shares, none above the tokens its cell has; a document is then sampled with the
probability that gives its cell the raked weight. Targets that the tokens do not allow
are met as far as they go, and ``reached`` tells them. Only cells take part in the
fitting, not documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindlewave.llm.common import dropped, stored, unit

SWEEPS, CLOSE = 20, 1e-12  # over all margins; change of a weight at which fitting ends
BOUNDED, NEAR = 200, 1e-8  # the same where no cell may get more than its tokens
AT_ONCE = 4  # of these sweeps in one job, behind which the end of fitting is tested
RESCALES = 8  # to make up for cells that have too few tokens
FEW = 100_000  # cells up to which one task rakes them, and they are sent to every executor


@dataclass(frozen=True)
class Margin:
    """Target shares of the values of a column.

    Without ``shares`` a value's target is its share of tokens to the ``power`` (0 makes
    all values equal, 1 leaves them as they are), scaled to 1. With ``shares`` the values
    named there divide among them, in these proportions, what the others leave; values
    that are not named keep their share. Null is a value of its own.
    """

    column: str
    power: float = 1.0
    shares: dict[str, float] = field(default_factory=dict)


def topic(text: str = "text") -> Column:
    """A topic by the form of the text: table, symbols, capitals, brief or prose."""
    text = F.coalesce(F.col(text), F.lit(""))
    size = F.length(text)

    def holds(characters: str) -> Column:
        return size - F.length(F.translate(text, characters, ""))

    return (
        F.when(holds("|") * 50 > size, "table")
        .when(holds("#$%&*") * 50 > size, "symbols")
        .when(holds("ABCDEFGHIJKLMNOPQRSTUVWXYZ") * 2 > size, "capitals")
        .when(size < 500, "brief")
        .otherwise("prose")
    )


def word_count(text: str = "text") -> Column:
    """Words as token weights; null has none."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def same(left: DataFrame, right: DataFrame, columns: dict[str, str]) -> list[Column]:
    """Null-safe equality of the columns of two tables, left name to right name."""
    return [left[a].eqNullSafe(right[b]) for a, b in columns.items()]


def targets(cells: DataFrame, margin: Margin) -> DataFrame:
    """value, tokens and target share (of 1) for each value of the margin that has tokens."""
    sums = cells.groupBy(F.col(margin.column).alias("__v")).agg(F.sum("__t").alias("__s")).where("__s > 0")
    if margin.shares:
        total = F.lit(float(sum(margin.shares.values())))
        named = F.col("__v").isin(*margin.shares)
        wanted = F.element_at(F.create_map(*(F.lit(x) for kv in margin.shares.items() for x in kv)), F.col("__v"))
        sums = sums.withColumn("__named", F.coalesce(named, F.lit(False)))
        whole = sums.agg(
            F.sum("__s").alias("__all"), F.sum(F.when(F.col("__named"), F.col("__s"))).alias("__mine"),
            F.sum(F.when(F.col("__named"), wanted / total)).alias("__wanted"),
        )
        share = F.when(
            F.col("__named"), wanted / total / F.col("__wanted") * F.col("__mine") / F.col("__all")
        ).otherwise(F.col("__s") / F.col("__all"))
    else:
        raised = F.pow(F.col("__s").cast("double"), F.lit(margin.power))
        whole = sums.agg(F.sum(raised).alias("__all"))
        share = raised / F.col("__all")
    # One row of totals; joined on a constant, so no task holds all values.
    one = whole.withColumn("__one", F.lit(1))
    return sums.withColumn("__k", F.lit(1)).join(F.broadcast(one), F.col("__k") == F.col("__one")).select("__v", "__s", share.alias("__target"))


def possible(goal: DataFrame, whole: float) -> DataFrame:
    """value and tokens to sample of it, ``whole`` tokens in all.

    A value that has fewer tokens than its target gives all it has; what is missing comes from
    the others in proportion to their targets.
    """
    scale = whole
    while True:
        short = F.col("__target") * F.lit(scale) >= F.col("__s")
        given, open_ = goal.agg(F.sum(F.when(short, F.col("__s"))), F.sum(F.when(~short, F.col("__target")))).first()
        more = (whole - (given or 0)) / open_ if open_ else scale
        if more <= scale * (1 + CLOSE):
            break
        scale = more
    return goal.select("__v", F.least(F.col("__s").cast("double"), F.col("__target") * F.lit(scale)))


def rake(cells: DataFrame, margins: list[Margin], keep: float | None = None) -> DataFrame:
    """Add ``__w``: cell weights whose margins are the targets, as near as the cells allow.

    ``cells`` has the margins' columns and tokens ``__t``. Values and cells without
    tokens keep the weight 0. With ``keep`` the weights are tokens to sample, ``keep`` of all,
    and no cell's weight is above its tokens: cells that would be are held there while
    the others are raked to what is left of the targets. Fitting ends when weights settle, and
    after BOUNDED sweeps where targets exclude each other; ``largest_miss`` tells how far off
    the margins are then.
    """
    whole = None
    if keep is not None:
        cells = stored(cells, "cells")
        whole = keep * (cells.agg(F.sum("__t")).first()[0] or 0)
    source = cells
    for k, margin in enumerate(margins):
        goal = targets(source, margin)
        if whole is None:
            goal = goal.select("__v", "__target")
        else:
            goal = possible(stored(goal, "goal"), whole)
        goal = goal.toDF("__v", f"__g{k}")
        cells = cells.join(goal, cells[margin.column].eqNullSafe(goal["__v"]), "left").drop("__v")
    cells = stored(cells.withColumn("__w", F.col("__t").cast("double")), "cells")
    names = cells.columns[:-1]
    few = cells.count() <= FEW
    held = F.least(F.col("__t").cast("double"), F.col("__w"))  # a weight above the tokens counts as these
    loose = F.when(F.col("__w") < F.col("__t"), F.col("__w")).otherwise(F.lit(0.0))
    at_once = AT_ONCE if whole is not None else 1
    for _ in range(SWEEPS if whole is None else BOUNDED // at_once):
        now = (cells.coalesce(1) if few else cells).withColumn("__f", F.lit(0.0))
        for k, margin in list(enumerate(margins)) * at_once:
            sums = {"__s": F.col("__w")} if whole is None else {"__s": held, "__l": loose}
            if few:  # in one task, without an exchange
                over = Window.partitionBy(margin.column)
                now = now.withColumns({name: F.sum(value).over(over) for name, value in sums.items()})
            else:
                found = now.groupBy(F.col(margin.column).alias("__value"))
                found = found.agg(*(F.sum(value).alias(name) for name, value in sums.items()))
                now = now.join(found, now[margin.column].eqNullSafe(found["__value"]))
            goal, total = F.col(f"__g{k}"), F.nullif(F.col("__s"), F.lit(0.0))
            factor = goal / total
            if whole is not None:  # only what is not held can grow
                factor = F.when(goal > total, 1 + (goal - total) / F.nullif(F.col("__l"), F.lit(0.0))).otherwise(factor)
            factor = F.coalesce(factor, F.lit(1.0))
            # What is held stays within reach, so that weights stay finite where targets exclude each other.
            weight = F.col("__w") * factor if whole is None else F.least(F.col("__w") * factor, F.col("__t") * F.lit(1e9))
            moved = F.abs(factor - 1) if whole is None else F.abs(F.least(F.col("__t"), weight) - held) / F.nullif(F.col("__t"), F.lit(0))
            now = now.select(*names, weight.alias("__w"), F.greatest("__f", moved).alias("__f"))
        now = stored(now, "raked")
        change = now.agg(F.max("__f")).first()[0]
        dropped(cells)
        cells = now.drop("__f")
        if change is None or change < (CLOSE if whole is None else NEAR):
            break
    if whole is not None:
        cells = cells.withColumn("__w", held)
    return cells.drop(*[f"__g{k}" for k in range(len(margins))])


def probabilities(cells: DataFrame, keep: float) -> DataFrame:
    """Add ``__p``: the probability of sampling a cell's documents.

    It is in proportion to the cell's weight by its tokens, and 1 at most; the whole is
    scaled to sample ``keep`` of all tokens, if the cells with weight have them. Cells
    without tokens are kept.
    """
    scale = None
    total = cells.agg(F.sum("__t"), F.sum("__w")).first()
    if total[0]:
        scale = keep * total[0] / total[1]
        for _ in range(RESCALES):
            found = cells.agg(F.sum(F.least(F.col("__t").cast("double"), F.col("__w") * scale))).first()[0]
            scale *= keep * total[0] / found
    chance = F.when(F.col("__t") > 0, F.least(F.lit(1.0), F.col("__w") * F.lit(scale) / F.col("__t"))).otherwise(1.0)
    return cells.withColumn("__p", F.round(chance, 9))


def described(docs: DataFrame, weight: Column | None = None, topics: Column | None = None) -> DataFrame:
    """The rows with topic and tokens, from their text unless given (columns of these names are replaced)."""
    return docs.withColumns(
        {"topic": topic() if topics is None else topics, "tokens": word_count() if weight is None else weight}
    )


def mixed(rows: DataFrame, margins: list[Margin], keep: float = 0.7, bounded: bool = True) -> DataFrame:
    """Rows that have ``tokens``, with probability and sampled (columns of these names are replaced).

    Margins name columns of ``rows``. They are read twice, so rows that are costly to
    describe should be stored first. Whether a row is sampled depends on its doc_id
    alone, so repeated rows share their fate; rows without an id are always
    sampled. Rows without tokens (null and empty texts) weigh nothing; in a cell of
    such rows only, the probability is 1. An empty table stays empty. Without ``bounded``
    cells are raked regardless of their tokens and cut to them afterwards, so margins
    with such cells miss their targets.
    """
    rows = rows.drop("probability", "sampled")
    names = [margin.column for margin in margins]
    cells = rows.groupBy(*names).agg(F.sum("tokens").alias("__t"))
    cells = probabilities(rake(cells, margins, keep if bounded else None), keep)
    cells = cells.select(*(F.col(name).alias(f"__{name}") for name in names), "__p")
    if cells.count() <= FEW:
        cells = F.broadcast(cells)
    found = rows.join(cells, [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in names], "left")
    found = found.withColumn("probability", F.col("__p")).drop("__p", *(f"__{name}" for name in names))
    return found.withColumn("sampled", F.coalesce(unit(F.col("doc_id")), F.lit(0.0)) < F.col("probability"))


def largest_miss(found: DataFrame, margins: list[Margin]) -> float:
    """How far the share of any value of any margin lies from its target; 0 without tokens."""
    return reached(found, margins).agg(F.max(F.abs(F.col("reached") - F.col("target")))).first()[0] or 0.0


def reached(found: DataFrame, margins: list[Margin]) -> DataFrame:
    """margin, value, target, reached: the shares of the tokens that ``mixed`` samples, by probability."""
    parts = []
    for margin in margins:
        cells = found.groupBy(margin.column).agg(
            F.sum("tokens").alias("__t"), F.sum(F.col("tokens") * F.col("probability")).alias("__r")
        )
        goal = targets(cells.select(margin.column, "__t"), margin)
        whole = found.agg(F.sum(F.col("tokens") * F.col("probability")).alias("__all"))
        part = goal.join(cells, goal["__v"].eqNullSafe(cells[margin.column])).crossJoin(F.broadcast(whole))
        share = (F.col("__r") / F.col("__all")).alias("reached")
        parts.append(part.select(F.lit(margin.column).alias("margin"), F.col("__v").alias("value"), F.col("__target").alias("target"), share))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
