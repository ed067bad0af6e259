"""Secrets in texts: known patterns, and formats learned from what these find.

The values found by the known patterns are labelled credentials. Per kind, their prefix
tree over character classes is merged into a probabilistic automaton (ALERGIA: states
whose outgoing frequencies agree by the Hoeffding bound become one). All long runs of
credential characters are scored by these automata against a chain of classes counted
over all such runs of the corpus, without the known values; a run that fits a learned format is a span of kind
``format``. So are the parts of a run that begin behind one of ``=/.`` and end with it or before the
next of them, and the pieces of a run beside known credentials. Spans of the known patterns always stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewave.llm.common import hashed_sample, opened, runs, shared, stored, utf8

KINDS = ("assign", "access", "hex", "format")  # in the order of spans that start together
ASSIGN = re.compile(
    rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
VALUE, ACCESS_SIZE, HEX_SIZE = 8, 16, 32  # least sizes

RUN = 1 << 19  # bytes of text handled at once
SAMPLE = 1000  # labelled credentials of a kind that an automaton is learned from
LONGEST = 256  # longer ones are not learned from (all are scored)
LONG = 1024  # longer runs are scored in blocks, all blocks side by side
ALPHA = 0.05  # of the Hoeffding bound
TAIL = 0.01  # share of the labelled credentials that may score below the limit
MARGIN = 8.0  # nats by which a format must beat the chain

SYMBOLS = b"+/_.=-"
N = 5 + len(SYMBOLS)  # classes
PARTING = np.isin(np.arange(N + 1), [5 + SYMBOLS.index(c) for c in b"=/."])  # a value may begin behind these


def _classes() -> np.ndarray:
    """Digits, a-f, g-z, A-F, G-Z and each symbol; N for all other bytes."""
    found = np.full(256, N, np.int8)
    for k, letters in enumerate((b"0123456789", b"abcdef", b"ghijklmnopqrstuvwxyz", b"ABCDEF", b"GHIJKLMNOPQRSTUVWXYZ")):
        found[list(letters)] = k
    found[list(SYMBOLS)] = np.arange(5, N)
    return found


CLASS = _classes()


@dataclass
class Automaton:
    """States by number: next state by class (-1: none), log probabilities of classes and of the end."""

    step: np.ndarray
    log: np.ndarray
    end: np.ndarray
    least: float = -math.inf  # mean log likelihood a symbol below which a run does not fit


@dataclass
class Model:
    automata: dict[str, Automaton]
    chain: np.ndarray  # log probabilities [N + 1, N + 1]; N stands for begin and end


def prefix_tree(values: list[tuple[bytes, int]]) -> tuple[list[dict], list[dict], list[int]]:
    """Children, counts by class and counts of ends of each node."""
    children, counts, ends = [{}], [{}], [0]
    for value, times in values:
        node = 0
        for symbol in CLASS[np.frombuffer(value, np.uint8)].tolist():
            counts[node][symbol] = counts[node].get(symbol, 0) + times
            if symbol not in children[node]:
                children[node][symbol] = len(children)
                children.append({})
                counts.append({})
                ends.append(0)
            node = children[node][symbol]
        ends[node] += times
    return children, counts, ends


def merge_states(children: list[dict], counts: list[dict], ends: list[int], alpha: float) -> list[int]:
    """ALERGIA: merge each new state into the first settled one it agrees with; returns the settled."""
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def agree(a: int, b: int) -> bool:
        waiting = [(a, b)]
        while waiting:
            x, y = waiting.pop()
            n1, n2 = ends[x] + sum(counts[x].values()), ends[y] + sum(counts[y].values())
            if differ(ends[x], n1, ends[y], n2):
                return False
            for symbol in counts[x].keys() | counts[y].keys():
                if differ(counts[x].get(symbol, 0), n1, counts[y].get(symbol, 0), n2):
                    return False
            waiting += [(children[x][s], child) for s, child in children[y].items() if s in children[x]]
        return True

    def fold(a: int, b: int) -> None:
        waiting = [(a, b)]
        while waiting:
            x, y = waiting.pop()
            ends[x] += ends[y]
            for symbol, n in counts[y].items():
                counts[x][symbol] = counts[x].get(symbol, 0) + n
            for symbol, child in children[y].items():
                if symbol in children[x]:
                    waiting.append((children[x][symbol], child))
                else:
                    children[x][symbol] = child

    settled, new = [0], [(0, symbol) for symbol in sorted(children[0])]
    while new:
        parent, symbol = new.pop(0)
        state = children[parent][symbol]
        if state in settled:
            continue
        for other in settled:
            if agree(other, state):
                children[parent][symbol] = other
                fold(other, state)
                break
        else:
            settled.append(state)
        known = set(settled)
        new = [(s, c) for s in settled for c in sorted(children[s]) if children[s][c] not in known]
    return settled


def infer(values: list[tuple[bytes, int]], alpha: float = ALPHA, tail: float = TAIL) -> Automaton:
    """The automaton of labelled credentials (value, times), and the limit by their own scores."""
    children, counts, ends = prefix_tree(values)
    settled = merge_states(children, counts, ends, alpha)
    number = {state: k for k, state in enumerate(settled)}
    step = np.full((len(settled), N), -1, np.int32)
    log = np.zeros((len(settled), N))
    end = np.zeros(len(settled))
    for state, k in number.items():
        total = ends[state] + sum(counts[state].values()) + 0.01 * (N + 1)
        end[k] = math.log((ends[state] + 0.01) / total)
        for symbol in range(N):
            log[k, symbol] = math.log((counts[state].get(symbol, 0) + 0.01) / total)
            if symbol in children[state]:
                step[k, symbol] = number[children[state][symbol]]
    found = Automaton(step, log, end)
    sizes = np.array([len(value) for value, _ in values])
    symbols = CLASS[np.frombuffer(b"".join(value for value, _ in values), np.uint8)]
    scores = likelihood(found, symbols, np.cumsum(sizes) - sizes, sizes) / (sizes + 1)
    found.least = float(np.quantile(scores, tail))
    return found


def likelihood(automaton: Automaton, symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log likelihood of each run of classes, all runs a step at a time, long ones in blocks."""
    long = sizes > LONG
    if long.any():
        found = np.empty(len(sizes))
        found[~long] = likelihood(automaton, symbols, begins[~long], sizes[~long])
        found[long] = rests(automaton, symbols, begins[long], sizes[long])[1]
        return found
    order = np.argsort(-sizes, kind="stable")
    total, state = np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)
    alive = len(order)
    for at in range(int(sizes.max(initial=0))):
        while sizes[order[alive - 1]] <= at:
            alive -= 1
        rows = order[:alive]
        symbol = symbols[begins[rows] + at].astype(np.int64)
        total[rows] += automaton.log[state[rows], symbol]
        after = automaton.step[state[rows], symbol]
        state[rows] = np.where(after >= 0, after, 0)  # an unseen step has its price; go on from the start
    return total + automaton.end[state]


def blocks_of(begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The blocks of at most LONG that runs are cut into: begins, sizes, and where a run's blocks start."""
    number = np.maximum(-(-sizes // LONG), 1)
    starts = np.concatenate([[0], np.cumsum(number)])
    owner = np.repeat(np.arange(len(sizes)), number)
    nth = np.arange(starts[-1]) - starts[owner]
    begin = begins[owner] + nth * LONG
    return begin, np.minimum(LONG, (begins + sizes)[owner] - begin), starts


def rests(
    automaton: Automaton, symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of what follows each block, from every state [blocks, states], and of the whole runs.

    What a block does to each state does not depend on the blocks before it, so all blocks
    are read side by side; then they are put together, block by block.
    """
    begin, size, starts = blocks_of(begins, sizes)
    states = len(automaton.end)
    total, state = np.zeros((len(begin), states)), np.tile(np.arange(states), (len(begin), 1))
    step = np.where(automaton.step >= 0, automaton.step, 0)
    for at in range(LONG):
        rows = np.flatnonzero(size > at)
        if not len(rows):
            break
        symbol = symbols[begin[rows] + at].astype(np.int64)[:, None]
        total[rows] += automaton.log[state[rows], symbol]
        state[rows] = step[state[rows], symbol]
    after, whole = np.empty((len(begin), states)), np.empty(len(sizes))
    for run, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
        rest = automaton.end
        for block in range(b - 1, a - 1, -1):
            after[block] = rest
            rest = total[block] + rest[state[block]]
        whole[run] = rest[0]
    return after, whole


def chain_counts(symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How often a class follows another in the runs, with begin and end."""
    found = np.zeros((N + 1, N + 1), np.int64)
    if len(begins):
        inner = np.ones(int(sizes.sum()), bool)
        starts = np.cumsum(sizes) - sizes
        source = np.arange(len(inner)) + np.repeat(begins - starts, sizes)
        run = symbols[source].astype(np.int64)
        before = np.append(N, run[:-1])
        before[starts] = N
        np.add.at(found, (before, run), 1)
        np.add.at(found, (run[starts + sizes - 1], np.full(len(starts), N)), 1)
    return found


def chain_scores(chain: np.ndarray, symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log likelihood of each run by the chain; runs may overlap."""
    ends = begins + sizes
    upto = np.concatenate([[0.0], np.cumsum(chain[symbols[:-1], symbols[1:]])])
    return chain[N, symbols[begins]] + upto[ends - 1] - upto[begins] + chain[symbols[ends - 1], N]


def tails(
    automaton: Automaton, symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray, marks: np.ndarray, owners: np.ndarray
) -> np.ndarray:
    """Log likelihood from each mark to the end of the run that owns it, all marks of a run at once.

    Runs are read backwards with the likelihood of the rest from every state; a long run
    as its blocks, each with the likelihood of what follows it.
    """
    found = np.empty(len(marks))
    last = np.tile(automaton.end, (len(sizes), 1))
    if (sizes > LONG).any():
        last, _ = rests(automaton, symbols, begins, sizes)
        first = begins
        begins, sizes, starts = blocks_of(begins, sizes)
        owners = starts[owners] + (marks - first[owners]) // LONG
    order = np.argsort(-sizes, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    ends = (begins + sizes)[order]
    far = ends[place[owners]] - marks
    near = np.argsort(far, kind="stable")
    cuts = np.searchsorted(far[near], np.arange(int(sizes.max(initial=0)) + 2))
    after, log = np.where(automaton.step >= 0, automaton.step, 0).T.copy(), automaton.log.T.copy()
    rest = last[order]
    alive = len(order)
    for back in range(1, int(far.max(initial=0)) + 1):
        while sizes[order[alive - 1]] < back:
            alive -= 1
        symbol = symbols[ends[:alive] - back]
        rest[:alive] = log[symbol] + np.take_along_axis(rest[:alive], after[symbol], 1)
        here = near[cuts[back] : cuts[back + 1]]
        found[here] = rest[place[owners[here]], 0]
    return found


class Scan:
    """The spans in a run of texts, which are parted by line feeds; places in bytes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        n = len(starts) - 1
        self.starts = starts[:-1] + np.arange(n)
        self.ends = starts[1:] + np.arange(n)
        joined = np.full(len(data) + n, 10, np.uint8)
        joined[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(starts))] = data
        self.data, self.raw = joined, joined.tobytes()
        self.symbols = CLASS[joined]
        self.begins, self.sizes = self._long(self.symbols, ACCESS_SIZE)
        self.base = sorted(self._base())  # (text, start, kind number, end), places in the run

    @staticmethod
    def _long(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Begins and sizes of the runs of at least so many credential characters."""
        other = np.flatnonzero(symbols == N)
        borders = np.concatenate([[-1], other])
        sizes = np.diff(borders) - 1  # every text is followed by a line feed
        long = np.flatnonzero(sizes >= least)
        return borders[long] + 1, sizes[long]

    def text_of(self, place: int) -> int:
        return int(np.searchsorted(self.starts, place, "right")) - 1

    def _base(self) -> Iterator[tuple[int, int, int, int]]:
        marks = np.flatnonzero((self.data == ord(":")) | (self.data == ord("=")))
        for text in np.unique(np.searchsorted(self.starts, marks, "right") - 1).tolist():
            a, b = int(self.starts[text]), int(self.ends[text])
            low = self.raw[a:b].lower()
            if any(word in low for word in WORDS):
                for match in ASSIGN.finditer(self.raw, a, b):
                    if match.end(2) - match.start(2) >= VALUE:
                        yield text, match.start(), 0, match.end()
        # Matches of the other kinds lie within long runs.
        for a, size in zip(self.begins.tolist(), self.sizes.tolist(), strict=True):
            part = self.raw[a : a + size]
            if b"AKIA" in part:
                for match in ACCESS.finditer(part):
                    if match.end() - match.start() >= ACCESS_SIZE:
                        yield self.text_of(a), a + match.start(), 1, a + match.end()
            if size >= HEX_SIZE:
                for match in HEX.finditer(part):
                    if match.end() - match.start() >= HEX_SIZE:
                        yield self.text_of(a), a + match.start(), 2, a + match.end()

    def labelled(self) -> Iterator[tuple[str, bytes]]:
        """Kind and value of each known credential; of an assignment the value assigned."""
        for _, start, kind, end in self.base:
            value = self.raw[start:end]
            yield KINDS[kind], ASSIGN.match(value).group(2) if kind == 0 else value

    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        """Begins and sizes of the runs that the known credentials leave, from the least size of a value."""
        free = self.symbols
        if self.base:
            free = free.copy()
            for _, start, _, end in self.base:
                free[start:end] = N
        return self._long(free, VALUE)

    def formats(self, model: Model) -> Iterator[tuple[int, int, int, int]]:
        """The pieces that fit a learned format, and of the others the parts that do (the longest)."""
        begins, sizes = self.pieces()
        if not len(begins) or not model.automata:
            return

        def fitting(begins: np.ndarray, sizes: np.ndarray, scored) -> np.ndarray:
            chain = chain_scores(model.chain, self.symbols, begins, sizes)
            fits = np.zeros(len(begins), bool)
            for automaton in model.automata.values():
                score = scored(automaton, begins, sizes)
                fits |= (score / (sizes + 1) >= automaton.least) & (score - chain >= MARGIN)
            return fits

        def whole(automaton: Automaton, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
            return likelihood(automaton, self.symbols, begins, sizes)

        fits = fitting(begins, sizes, whole)
        found = list(zip(begins[fits].tolist(), (begins + sizes)[fits].tolist(), strict=True))

        ends = begins + sizes
        cuts = np.flatnonzero(PARTING[self.symbols])
        owners = np.searchsorted(begins, cuts, "right") - 1
        inside = (owners >= 0) & (cuts < ends[owners]) & ~fits[owners]
        cuts, owners = cuts[inside], owners[inside]
        if len(cuts):
            # From behind a cut to the end of the piece.
            long = ends[owners] - cuts - 1 >= VALUE
            marks, of = cuts[long] + 1, owners[long]
            rows, of = np.unique(of, return_inverse=True)
            good = fitting(
                marks, ends[rows][of] - marks,
                lambda automaton, marks, _: tails(automaton, self.symbols, begins[rows], sizes[rows], marks, of),
            )
            found += zip(marks[good].tolist(), ends[rows][of][good].tolist(), strict=True)
            # From one cut, or the begin of the piece, to the next.
            rows = np.unique(owners)
            borders = np.sort(np.concatenate([begins[rows] - 1, cuts, ends[rows]]))
            # A piece may end where the next begins, so its border stands there twice.
            starts, stops = borders[:-1] + 1, borders[1:]
            at = np.searchsorted(begins, starts, "right") - 1
            real = (stops - starts >= VALUE) & (at >= 0) & (stops <= ends[at])
            starts, stops = starts[real], stops[real]
            good = fitting(starts, stops - starts, whole)
            found += zip(starts[good].tolist(), stops[good].tolist(), strict=True)
        reach = 0
        for start, end in sorted(found, key=lambda span: (span[0], -span[1])):
            if start >= reach:  # not within a longer one
                yield self.text_of(start), start, 3, end
                reach = end

    def characters(self, spans: list[tuple[int, int, int, int]]) -> dict[int, list[tuple[int, int, int]]]:
        """By text the spans (start, kind number, end) in code points of the text."""
        if not spans:
            return {}
        upto = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        found: dict[int, list[tuple[int, int, int]]] = {}
        for text, start, kind, end in sorted(spans):
            first = upto[self.starts[text]]
            found.setdefault(text, []).append((int(upto[start] - first), kind, int(upto[end] - first)))
        return found


def scans(column: pa.Array) -> Iterator[tuple[int, int, Scan]]:
    """Runs [a, b) of texts with what is found in them; null is empty."""
    data, starts = utf8(column)
    for a, b in runs(starts, RUN):
        yield a, b, Scan(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])


def learn(docs: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> Model:
    """Learn the formats from the credentials that the known patterns find in all texts.

    An automaton is learned from at most ``sample`` different credentials of a kind (the
    first by hash), each weighted by how often it occurs; the chain from all pieces. Without
    credentials of a kind there is no automaton for it.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((N + 1, N + 1), np.int64)
        for batch in batches:
            for _, _, scan in scans(batch.column("text")):
                total += chain_counts(scan.symbols, *scan.pieces())
                found = [(kind, value) for kind, value in scan.labelled() if len(value) <= longest]
                if found:
                    kinds, values = zip(*found, strict=True)
                    n = len(found)
                    columns = [pa.array(kinds), pa.array([v.decode() for v in values]), pa.array([1] * n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["kind", "value", "n"])
        where = np.argwhere(total)
        names = [f"{a} {b}" for a, b in where]
        columns = [pa.array(["chain"] * len(names), pa.string()), pa.array(names, pa.string()), pa.array(total[total > 0])]
        yield pa.RecordBatch.from_arrays(columns, ["kind", "value", "n"])

    rows = docs.select("text").mapInArrow(read, "kind string, value string, n long")
    rows = stored(rows.groupBy("kind", "value").agg(F.sum("n").alias("n")), "labelled")
    counts = np.full((N + 1, N + 1), 0.5)
    for row in rows.where("kind = 'chain'").collect():
        a, b = map(int, row["value"].split())
        counts[a, b] += row["n"]
    automata = {}
    for kind in KINDS[:3]:
        part = hashed_sample(rows.where(F.col("kind") == kind), ["value"], sample)
        values = [(row["value"].encode(), row["n"]) for row in part.collect()]
        if values:
            automata[kind] = infer(sorted(values))
    return Model(automata, np.log(counts / counts.sum(axis=1, keepdims=True)))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secret_spans(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_format for every row.

    Null, empty and clean texts have counts of 0 and no spans. Places are code points,
    ends exclusive. Repeated rows and null ids are rows like any other; other columns
    are not read.
    """
    sent = shared(docs.sparkSession, model)
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"]
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [T.StructField(name, T.LongType()) for name in names[1:4]]
        + [T.StructField(name, T.StringType()) for name in names[4:6]]
        + [T.StructField("n_format", T.LongType())]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = opened(sent)
        for batch in batches:
            for a, b, scan in scans(batch.column("text")):
                found = scan.characters([*scan.base, *scan.formats(known)])
                rows = []
                for text in range(b - a):
                    spans = found.get(text, [])
                    base = joined([span for span in spans if span[1] < 3])
                    numbers = [sum(span[1] == kind for span in spans) for kind in range(4)]
                    rows.append((*numbers[:3], hashlib.sha256(base.encode()).hexdigest(), joined(spans), numbers[3]))
                columns = [batch.column("doc_id").slice(a, b - a)]
                columns += [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(find, schema)


def redacted(docs: DataFrame, model: Model, mark: str = "[SECRET]") -> DataFrame:
    """The rows with every span replaced by ``mark``; spans that overlap become one mark.

    Rows without spans stay as they are, null texts too. ``n_chars``, if there is such
    a column, is the length of the new text where the text has changed.
    """
    sent = shared(docs.sparkSession, model)
    schema = docs.schema
    names = schema.fieldNames()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = opened(sent)
        for batch in batches:
            for a, b, scan in scans(batch.column("text")):
                part = batch.slice(a, b - a)
                found = scan.characters([*scan.base, *scan.formats(known)])
                if found:
                    columns = {name: part.column(name) for name in names}
                    texts = columns["text"].to_pylist()
                    for text, spans in found.items():
                        texts[text] = replaced(texts[text], spans, mark)
                    columns["text"] = pa.array(texts, columns["text"].type)
                    if "n_chars" in columns:
                        sizes = columns["n_chars"].to_pylist()
                        for text in found:
                            sizes[text] = len(texts[text])
                        columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
                    part = pa.RecordBatch.from_arrays(list(columns.values()), names)
                yield part

    return docs.mapInArrow(clean, schema)


def replaced(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    parts, at, end = [], 0, -1
    for start, _, stop in sorted(spans):
        if start >= end:  # not within the span before
            if end >= 0:
                at = end
            parts += [text[at:start], mark]
            end = stop
        else:
            end = max(end, stop)
    return "".join(parts) + text[end:]
