"""Words of many texts as spans of one byte array, and hashes of spans."""

from __future__ import annotations

import numpy as np

from spindlewave.llm.common import mix
from spindlewave.llm.shingles import GOLDEN, powers


def lowered() -> np.ndarray:
    """The byte each byte stands for: A-Z as a-z, all others themselves."""
    found = np.arange(256, dtype=np.uint8)
    found[65:91] = found[97:123]
    return found


LOWER = lowered()
NUMBERS = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)


def spans(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of marked bytes begin and end; a run ends with its text at the latest."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = starts[:-1] < starts[1:]
    begins, ends = starts[:-1][filled], starts[1:][filled] - 1
    first[begins] |= inside[begins]
    last[ends] |= inside[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Hashes:
    """64-bit hashes of spans of lower-cased bytes; they depend on the bytes alone."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        up, self.down = powers(max(len(data), 1))
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(mix(NUMBERS + np.uint64(seed))[LOWER[data]] * up[: len(data)], out=self.total[1:])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix((self.total[last] - self.total[first]) * self.down[first] + (last - first).astype(np.uint64) * GOLDEN)
