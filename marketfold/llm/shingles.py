"""Hashed word shingles of whole texts, computed on bytes with arrays."""

from __future__ import annotations

import numpy as np

# Blanks and the control characters from tab to carriage return end a word.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# Odd, so that its powers have inverses modulo 2**64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of the base and of its inverse, as long as the longest text so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 65_536)
            self.up = np.cumprod(np.append(np.uint64(1), np.full(size, _BASE)))
            self.down = np.cumprod(np.append(np.uint64(1), np.full(size, _INVERSE)))
        return self.up, self.down


_powers = Powers()


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, in order; plain capital letters count as small ones."""
    data = _LOWER[np.frombuffer(text.encode(), np.uint8)]
    if not len(data):
        return np.empty(0, np.uint64)
    edge = np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers.upto(len(data) + 1)
    summed = np.concatenate(([np.uint64(0)], np.cumsum(_VALUE[data] * up[: len(data)])))
    return mix((summed[end] - summed[begin]) * down[begin] + (end - begin).astype(np.uint64))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Distinct hashes, ascending, of all runs of ``size`` words.

    A text of fewer words has one shingle, its whole sequence; a text without words has none.
    """
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    hashed = np.full(count, np.uint64(size))
    for i in range(size):
        hashed = mix(hashed * _BASE + words[i : i + count])
    return np.unique(hashed)
