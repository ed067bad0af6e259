"""Wear states: class codes, labels and their maximum."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlewave.schema import FAILED_STATE, WEAR_STATES


def state_label(code: Column) -> Column:
    """Class code to wear state; any other code is a failed prediction."""
    label = F.lit(FAILED_STATE)
    for value, name in enumerate(WEAR_STATES):
        label = F.when(code == value, F.lit(name)).otherwise(label)
    return label


def state_code(state: Column) -> Column:
    """Wear state, given as a name or as a class code, to its class code."""
    text = F.lower(F.trim(state.cast("string")))
    code = F.lit(None).cast("int")
    for value, name in enumerate(WEAR_STATES):
        code = F.when(text.isin(name, str(value)), F.lit(value)).otherwise(code)
    return code


WIDTH = 14  # bytes of a text that a code holds
_LOW = "18446744073709551616"  # 2 ** 64


def text_code(text: Column) -> Column:
    """A text's first WIDTH bytes as a number, and whether there are more as its last bit.

    Codes are in the order of texts, but for longer texts that begin alike. As numbers of fixed width
    they can be compared in a hash aggregate.
    """
    data = F.encode(text, "UTF-8")
    digits = F.rpad(F.substring(F.hex(data), 1, 2 * WIDTH), 2 * WIDTH, "0")
    high, low = (
        F.conv(F.substring(digits, begin, size), 16, 10).cast("decimal(20,0)") for begin, size in ((1, 12), (13, 16))
    )
    longer = F.when(F.octet_length(text) > WIDTH, 1).otherwise(0)
    return (high * F.lit(_LOW).cast("decimal(20,0)") + low).cast("decimal(37,0)") * F.lit(2) + longer


def code_text(code: Column) -> Column:
    """The text of a code; null for one of a longer text."""
    longer = code % F.lit(2)
    whole = ((code - longer) * F.lit("0.5").cast("decimal(1,1)")).cast("decimal(37,0)")
    low = (whole % F.lit(_LOW).cast("decimal(20,0)")).cast("decimal(20,0)")
    high = ((whole - low) / F.lit(_LOW).cast("decimal(20,0)")).cast("long")
    digits = F.concat(F.lpad(F.hex(high), 12, "0"), F.lpad(F.conv(low.cast("string"), 10, 16), 16, "0"))
    bytes_ = F.unhex(F.regexp_extract(digits, "^((?:..)*?)(?:00)*$", 1))
    return F.when(longer == 0, F.decode(bytes_, "UTF-8"))


class StateMax:
    """``max(state)`` in text order, without sorting.

    A text maximum has no fixed-width buffer, so it turns the whole aggregate
    into a sort. With the possible states given as ``domain``, the maximum runs
    on their rank and the aggregate stays a hash aggregate. A state outside the
    domain then fails the job rather than give a wrong maximum. Without a domain it runs on the
    ``text_code`` of the states of a table. Whether any state is longer than a code is found
    out by a job of its own; only such rows are sorted, in a second pass (``settled``). On a stream
    without a domain the text itself is compared. An empty text is no state.
    """

    def __init__(self, state: str, domain: Sequence[str] | None = None, rows: DataFrame | None = None):
        self.state = state
        self.domain = sorted(set(domain)) if domain else None
        self.coded = domain is None and rows is not None and not rows.isStreaming
        self.long = None
        if self.coded:
            long = rows.where(F.octet_length(state) > WIDTH)
            self.long = None if long.select(state).isEmpty() else long

    def aggregate(self) -> Column:
        state = F.nullif(F.col(self.state), F.lit(""))
        if self.coded:
            return F.max(text_code(state))
        if self.domain is None:
            return F.max(state)
        # Binary order of UTF-8 text equals code point order, as in sorted().
        rank = F.when(
            state.isNotNull(),
            F.raise_error(F.concat(F.lit("state outside its domain: "), state)).cast("int"),
        )
        for value, name in enumerate(self.domain):
            rank = F.when(state == name, F.lit(value)).otherwise(rank)
        return F.max(rank)

    def settled(self, reduced: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
        """``reduced`` with ``_long``, the greatest of the long states by the keys of the aggregate, by name."""
        if self.long is None:
            return reduced
        named = [column.alias(f"_by{k}") for k, column in enumerate(keys.values())]
        # Windows are only columns once they have been selected.
        tops = self.long.select(*named, F.col(self.state).alias("_text"))
        tops = tops.groupBy(*[f"_by{k}" for k in range(len(named))]).agg(F.max("_text").alias("_long"))
        same = F.lit(True)
        for k, name in enumerate(keys):
            same &= reduced[name].eqNullSafe(tops[f"_by{k}"])
        return reduced.join(tops, same, "left").drop(*[f"_by{k}" for k in range(len(named))])

    def decode(self, aggregated: Column) -> Column:
        if self.coded:
            text = code_text(aggregated)
            return text if self.long is None else F.when(aggregated % F.lit(2) == 1, F.col("_long")).otherwise(text)
        if self.domain is None:
            return aggregated
        names = F.array(*[F.lit(name) for name in self.domain])
        return F.get(names, aggregated)
