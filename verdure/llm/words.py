"""Words of whole texts as numbers, for the operators that look at runs of words."""

from __future__ import annotations

import numpy as np

#: Odd multiplier of the rolling hashes (the fractional bits of the golden ratio).
MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _inverse(m: int) -> int:
    return pow(m, -1, 1 << 64)


INVERSE = np.uint64(_inverse(int(MULT)))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


class Powers:
    """MULT and INVERSE to the powers 0, 1, ..., kept and grown."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                full = lambda m: np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, m, np.uint64))])
                self.up, self.down = full(MULT), full(INVERSE)
        return self.up[:n], self.down[:n]


POWERS = Powers()
#: Which bytes part words: space, tab, newline, vertical tab, form feed, carriage return.
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a text's bytes."""
    gap = _GAP[raw]
    edge = np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial of its bytes, mixed with its length."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = POWERS.get(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], dtype=np.uint64)])
        poly = (sums[ends] - sums[starts]) * down[starts]
        return mix(poly + (ends - starts).astype(np.uint64) * _MIX2)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = POWERS.get(len(words) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)])
        return mix((sums[k:] - sums[:n]) * down[:n])


def window_min(values: np.ndarray, w: int) -> np.ndarray:
    """For each window of w values the place of its least one, the first of equals."""
    n = len(values) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at, width = values.copy(), np.arange(len(values)), 1
    while width < w:  # windows of ``width``, doubled until one more step of any size reaches w
        step = min(width, w - width)
        left, right = least[:-step] if step else least, least[step:]
        later = right < left
        at = np.where(later, at[step:], at[:-step])
        least = np.where(later, right, left)
        width += step
    return at[:n]
