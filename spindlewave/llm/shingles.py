"""Word shingles of whole texts as 64-bit hashes, many texts at a time.

Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return; A-Z are lower-cased. A text's set holds its distinct shingles of
``width`` words; with fewer words the whole sequence is the one member; without words
the set is empty. Two different members of a set agree in their hashes with a
probability of about 2 ** -64.
"""

from __future__ import annotations

import sys
import types

import numpy as np

from spindlewave.llm.common import mix

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2 ** 64

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _letters() -> np.ndarray:
    """A random 64-bit number for each byte, the same for both cases of a letter."""
    found = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
    found[65:91] = found[97:123]
    return found


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, kept by the worker for the longest run so far."""
    kept = vars(sys.modules.setdefault("_kept_powers", types.ModuleType("_kept_powers")))
    if len(kept.get("up", ())) < size:
        size = max(size, 1 << 19)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            kept[name] = np.multiply.accumulate(steps)
    return kept["up"], kept["down"]


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and the number of the text it belongs to."""
    size = len(data)
    if not size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = starts[:-1][starts[:-1] < starts[1:]]
    first[begins] |= inside[begins]
    ends = starts[1:][starts[:-1] < starts[1:]] - 1
    last[ends] |= inside[ends]
    first, last = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(size)
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(_letters()[data] * up[:size], out=total[1:])
    hashes = mix((total[last] - total[first]) * down[first])
    return hashes, np.searchsorted(starts, first, "right") - 1


def shingle_sets(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The members of all sets, sorted within each text, and the n + 1 places where sets start."""
    return sets_of(*words(data, starts), len(starts) - 1, width)


def sets_of(hashes: np.ndarray, text: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The same from the words of n texts."""
    count = np.bincount(text, minlength=n)
    begins = np.cumsum(count) - count
    # The hash of a whole short sequence is the shingle of fewer words.
    length = len(hashes)
    used = np.minimum(count, width)[text]
    alone = np.arange(length) - begins[text]
    keep = alone <= (count[text] - used)
    at = np.flatnonzero(keep)
    found, steps = hashes[at] * GOLDEN, used[at]
    for step in range(1, width):
        more = np.flatnonzero(steps > step)
        found[more] = mix(found[more] + hashes[at[more] + step] + GOLDEN) * GOLDEN
    found = mix(found + steps.astype(np.uint64))
    owner = text[at]
    fresh = sorted_within(found, owner, n)
    sizes = np.bincount(owner[fresh], minlength=n)
    return found[fresh], np.concatenate([[0], np.cumsum(sizes)])


def sorted_within(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sort the values of each of n owners in place; returns where a value differs from the one before."""
    cut = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return fresh
