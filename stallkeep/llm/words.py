"""Hashes of the words of many texts with array operations."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_STEP = 0x9E3779B97F4A7C15
_U = np.uint64

# Bytes of ASCII that are neither letters nor digits part words.
_PARTS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


class Words:
    """64-bit hashes of lower-cased words, alike in every process.

    A word is a run of letters, digits and characters beyond ASCII. Its hash sums
    a random factor for each byte times a random factor for its place, so that
    regular words meet no more often than others.
    """

    def __init__(self, window: int = 1 << 18):
        self._code = np.random.default_rng(9).integers(1, 1 << 63, 256, dtype=_U)
        self._most = window
        self._place = places(1 << 8)

    def hashes(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """One array of word hashes per text, in text order; a null text has none."""
        out: list[np.ndarray] = []
        held: list[bytes] = []
        size = 0
        for text in texts:
            raw = (text or "").lower().encode().translate(_PARTS) + b" "
            if held and size + len(raw) > self._most:
                out += self._window(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw)
        return out + (self._window(held) if held else [])

    def _window(self, raw: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b"".join(raw), np.uint8)
        word = data != 32
        change = np.flatnonzero(np.diff(word, prepend=False))
        starts, ends = change[::2], change[1::2]  # every text ends in a space
        sizes = ends - starts
        if len(sizes) and sizes.max() > len(self._place):
            self._place = places(1 << int(sizes.max()).bit_length())
        total = np.cumsum(sizes)
        at = np.arange(total[-1] if len(total) else 0) - np.repeat(total - sizes, sizes)
        sums = np.concatenate(([_U(0)], np.cumsum(self._code[data[word]] * self._place[at], dtype=_U)))
        found = mixed(sums[total] - sums[total - sizes] + sizes.astype(_U))
        return np.split(found, np.searchsorted(starts, np.cumsum([len(r) for r in raw])[:-1]))


def places(size: int) -> np.ndarray:
    """A random factor for each place in a word; a longer table begins with the shorter one."""
    return mixed(np.arange(1, size + 1, dtype=_U) * _U(_STEP))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finish that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; a shorter text is one run, an empty one none."""
    if not len(words):
        return words
    k = min(k, len(words))
    total = np.zeros(len(words) - k + 1, _U)
    for i in range(k):
        total = total * _U(_STEP) + words[i : len(words) - k + 1 + i]
    return mixed(total)
