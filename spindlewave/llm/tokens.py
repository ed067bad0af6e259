"""Token ids of whole texts with a public tokenizer.

Texts are cut into segments at places where the tokenizer is sure to cut as well. Most
segments have come before, and their ids are kept in a bounded memory of each Python
worker, by 128 bits of hash; only new segments go to the tokenizer. All steps work on
arrays of many texts.

The cuts hold for a tokenizer that drops white space, lower-cases, normalises to NFC and
takes runs of letters, single digits and runs of other characters as words, with
contractions after an apostrophe (as in word_bpe_49k.json). Whether a tokenizer does is read from
its file; any other one gets whole texts.
"""

from __future__ import annotations

import json
import os
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from spindlewave.llm.common import mix, runs, utf8

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

RUN = 1 << 18  # bytes of text handled at once
KEPT = 1_000_000  # segments in a worker's memory; it begins anew when there are more
TOGETHER = 500  # new segments encoded in one call

SPACE, LETTER, DIGIT, PUNCTUATION, OTHER = range(5)


def _classes() -> np.ndarray:
    found = np.full(256, OTHER, np.uint8)  # apostrophes, control characters, all beyond ASCII
    found[[9, 10, 13, 32]] = SPACE
    found[ord("A") : ord("Z") + 1] = found[ord("a") : ord("z") + 1] = LETTER
    found[ord("0") : ord("9") + 1] = DIGIT
    found[[c for c in range(33, 127) if not chr(c).isalnum() and c != ord("'")]] = PUNCTUATION
    return found


CLASS = _classes()
LATIN = 0xC3  # leads the two bytes of U+00C0 to U+00FF: letters but for two signs
SIGNS = (0x97, 0xB7)
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)  # odd, so they have inverses modulo 2 ** 64
NUMBERS = [mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(b)) for b in BASES]
for _numbers in NUMBERS:
    _numbers[65:91] = _numbers[97:123]


# What a tokenizer file has to say for the cuts to hold.
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
CUTTABLE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def cuttable(path: str) -> bool:
    """Whether the tokenizer of a file cuts texts where ``segments`` does."""
    with open(path, encoding="utf-8") as file:
        own = json.load(file)
    return all(own.get(name) == value for name, value in CUTTABLE.items()) and own["model"].get("end_of_word_suffix") == "</w>"


def kept(name: str, make):
    """What a worker keeps between tasks.

    The package travels to the workers by value, so its own globals last for one task.
    A module made here lasts as long as the worker.
    """
    store = vars(sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")))
    if name not in store:
        store[name] = make()
    return store[name]


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    found = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(RUN + 1, factor, np.uint64)
        steps[0] = 1
        found.append(np.multiply.accumulate(steps))
    return tuple(found)


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = kept(f"powers {base}", lambda: _powers(base))
    if size < len(up):
        return up, down
    steps = np.full(size + 1, base, np.uint64)  # a very long text
    inverse = np.full(size + 1, pow(base, -1, 1 << 64), np.uint64)
    steps[0] = inverse[0] = 1
    return np.multiply.accumulate(steps), np.multiply.accumulate(inverse)


def segments(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the segments of all texts.

    A cut is made at white space, at the borders of texts, and between a letter, a digit
    and ASCII punctuation, as far as both sides are known to be such; every digit stands
    alone. No cut is made beside an apostrophe or beside characters beyond Latin-1.
    """
    kind = CLASS[data]
    lead = np.flatnonzero(data[:-1] == LATIN) if len(data) else np.zeros(0, int)
    lead = lead[(data[lead + 1] != SIGNS[0]) & (data[lead + 1] != SIGNS[1])]
    kind[lead] = kind[lead + 1] = LETTER
    cut = np.zeros(len(data) + 1, bool)
    before, after = kind[:-1], kind[1:]
    cut[1:-1] = (before != after) & ((before < OTHER) & (after < OTHER))
    space = kind == SPACE
    cut[:-1] |= space
    cut[1:] |= space
    cut[1:-1] |= (before == DIGIT) & (after == DIGIT)
    cut[starts] = True
    places = np.flatnonzero(cut)
    begins, ends = places[:-1], places[1:]
    words = ~space[begins]
    return begins[words], ends[words]


class Memory:
    """Ids by 128-bit hash, in arrays: open addressing on the first half of the hash."""

    def __init__(self, kind: type):
        self.slots = 1 << 16
        self.first = np.zeros(self.slots, np.uint64)
        self.entry = np.zeros(self.slots, np.int32)
        self.second = np.zeros(1 << 15, np.uint64)
        self.place = np.zeros((1 << 15) + 1, np.int64)
        self.ids = np.zeros(1 << 17, kind)
        self.size = 0

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The entry of each hash, or -1."""
        mask = np.uint64(self.slots - 1)
        slot = (first & mask).astype(np.int64)
        there = self.first[slot]
        entry = np.where(there == first, self.entry[slot], -1).astype(np.int64)
        going = np.flatnonzero((there != first) & (there != 0))
        while len(going):
            slot[going] = (slot[going] + 1) & (self.slots - 1)
            there = self.first[slot[going]]
            same = there == first[going]
            entry[going[same]] = self.entry[slot[going[same]]]
            going = going[~same & (there != 0)]
        known = np.flatnonzero(entry >= 0)
        entry[known[self.second[entry[known]] != second[known]]] = -1
        return entry

    def _settle(self, first: np.ndarray, entries: np.ndarray) -> None:
        slot = (first & np.uint64(self.slots - 1)).astype(np.int64)
        going = np.arange(len(first))
        while len(going):
            free = going[self.first[slot[going]] == 0]
            self.first[slot[free]] = first[free]
            won = free[self.first[slot[free]] == first[free]]
            self.entry[slot[won]] = entries[won]
            lost = np.ones(len(first), bool)
            lost[won] = False
            going = going[lost[going]]
            slot[going] = (slot[going] + 1) & (self.slots - 1)

    def add(self, first: np.ndarray, second: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Keep new and distinct hashes with their ids; one whose first half is taken is left out."""
        new = self.size + len(first)
        while new > len(self.second):
            self.second = np.append(self.second, np.zeros_like(self.second))
            self.place = np.append(self.place, np.zeros(len(self.place) - 1, np.int64))
        end = int(self.place[self.size]) + len(ids)
        while end > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.ids[end - len(ids) : end] = ids
        entries = np.arange(self.size, new)
        self.second[entries] = second
        self.place[entries + 1] = self.place[self.size] + np.cumsum(lengths)
        self.size = new
        if 2 * new > self.slots:
            while 2 * new > self.slots:
                self.slots *= 2
            old = np.flatnonzero(self.first)
            names, entry = self.first[old], self.entry[old]
            self.first = np.zeros(self.slots, np.uint64)
            self.entry = np.zeros(self.slots, np.int32)
            self._settle(names, entry)
        free = first != 0
        self._settle(first[free], entries[free])


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cuttable = cuttable(path)
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.last = np.zeros(size, bool)  # ids that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [token.encode() for token in _specials(self.tokenizer)]
        self.memory = Memory(self.kind)

    def _encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new segments, one after the other, and their numbers."""
        found: list = [None] * len(chunks)
        words, others = [], []
        for at, chunk in enumerate(chunks):
            # Letters alone are one word; words are told apart again by the ids that end them.
            (words if chunk.isalpha() or chunk.decode().lower().isalpha() else others).append(at)
        for a in range(0, len(words), TOGETHER):
            part = words[a : a + TOGETHER]
            text = b" ".join([chunks[at] for at in part]).decode()
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part):
                others += part
                continue
            begin = 0
            for at, end in zip(part, ends.tolist(), strict=True):
                found[at] = ids[begin:end]
                begin = end
        for a in range(0, len(others), TOGETHER):
            part = others[a : a + TOGETHER]
            texts = [chunks[at].decode() for at in part]
            for at, ids in zip(part, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                found[at] = np.array(ids.ids, self.kind)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return (np.concatenate(found) if found else np.zeros(0, self.kind)), lengths

    def encode_run(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the n + 1 places where a text's begin."""
        begins, ends = segments(data, starts)
        sizes = ends - begins
        hashes = []
        for base, numbers in zip(BASES, NUMBERS, strict=True):
            up, down = powers(base, len(data))
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(numbers[data] * up[: len(data)], out=total[1:])
            hashes.append(mix((total[ends] - total[begins]) * down[begins] + sizes.astype(np.uint64)))
        first, second = hashes
        if self.memory.size > KEPT:
            self.memory = Memory(self.kind)
        entry = self.memory.find(first, second)
        new = np.flatnonzero(entry < 0)
        if len(new):
            _, at = np.unique(first[new], return_index=True)
            at = new[at]
            raw = data.tobytes()
            chunks = [raw[a:b] for a, b in zip(begins[at].tolist(), ends[at].tolist(), strict=True)]
            self.memory.add(first[at], second[at], *self._encode(chunks))
            entry[new] = self.memory.find(first[new], second[new])
        place = self.memory.place
        odd = np.flatnonzero(entry < 0)
        if len(odd):  # two segments share half a hash: encode these texts as they are
            return self._whole(data, starts)
        begin, number = place[entry], place[entry + 1] - place[entry]
        upto = np.concatenate([[0], np.cumsum(number)])
        source = np.arange(upto[-1]) + np.repeat(begin - upto[:-1], number)
        return self.memory.ids[source], upto[np.searchsorted(begins, starts, "left")]

    def _whole(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = [np.array(x, self.kind) for x in found]
        return np.concatenate([np.zeros(0, self.kind), *ids]), np.concatenate([[0], np.cumsum([len(x) for x in ids])])

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Runs of texts: the number of the first, their ids, and the places where each text's ids begin.

        A null text is empty. Texts that hold the name of a special token go to the
        tokenizer whole, since such names are found before anything else; so do all texts
        where the cuts do not hold.
        """
        data, starts = utf8(column)
        for a, b in runs(starts, RUN):
            part, places = data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
            raw = part.tobytes()
            if not self.cuttable or any(name in raw for name in self.special):
                yield a, *self._whole(part, places)
            else:
                yield a, *self.encode_run(part, places)


def _specials(tokenizer) -> list[str]:
    return [token.content for token in tokenizer.get_added_tokens_decoder().values()]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, made once."""
    return kept(f"encoder {path}", lambda: Encoder(path))
