"""A bounded table of word ids under hashes of the words' bytes."""

from __future__ import annotations

import numpy as np

from stallkeep.llm.words import mixed, places

WINDOW = 1 << 20  # bytes hashed together


class WordTable:
    """Ids of words, cut out of a window of bytes by array operations.

    A subclass says in ``_ids_of`` what the ids of new words are, one after
    another, below 65,536 each, how many each word has, and ``values`` numbers
    beside them. A 64-bit hash finds a word's slot, and its bytes, which the table
    keeps, are compared there; a word whose hash another word holds goes by a
    second hash, and so on. A full table is emptied.
    """

    values = 0

    def __init__(self, known_words: int):
        self._limit = known_words
        self._clear()
        rng = np.random.default_rng(20)
        self._code = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self._factor = places(1 << 8)

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        raise NotImplementedError

    def _hashes(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Never 0, which marks a free slot. ``at`` holds the place of each byte in its word."""
        if sizes.max() > len(self._factor):
            self._factor = places(1 << int(sizes.max()).bit_length())
        total = np.cumsum(sizes)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(self._code[data] * self._factor[at], dtype=np.uint64)))
        return mixed(sums[total] - sums[total - sizes] + sizes.astype(np.uint64)) | np.uint64(1)

    def _find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The slot of each word; the words lie side by side and fill data, and new ones are added."""
        sizes = ends - starts
        at = np.arange(len(data)) - np.repeat(starts, sizes)
        keys = self._hashes(data, starts, sizes, at)
        slots = self._probe(keys)
        new = np.flatnonzero(self._keys[slots] != keys)
        full = self._words + len(keys) >= len(self._keys)
        if len(new) or full:
            first = new[np.unique(keys[new], return_index=True)[1]]
            if full or self._words + len(first) > self._limit:
                first = np.unique(keys, return_index=True)[1]
                self._clear(len(keys))
            self._learn(data, starts, ends, first, keys)
            slots = self._probe(keys)
        # Words that are not what their slot holds.
        same = self._size[slots] == sizes
        if same.all():
            wrong = np.flatnonzero(self._bytes[np.repeat(self._begin[slots], sizes) + at] != data)
            other = np.unique(np.searchsorted(ends, wrong, "right"))
        else:
            other = np.flatnonzero(~same | [self._held(s) != data[a:b].tobytes() for s, a, b in zip(slots.tolist(), starts.tolist(), ends.tolist(), strict=True)])
        for k in other.tolist():
            slots[k] = self._apart(data, starts, ends, k, keys[k : k + 1])
        return slots

    def _apart(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int, key: np.ndarray) -> int:
        """The slot of word k, whose hash ``key`` is that of another word."""
        word = data[starts[k] : ends[k]].tobytes()
        while True:
            key = mixed(key + np.uint64(2)) | np.uint64(1)
            slot = int(self._probe(key)[0])
            if self._keys[slot] != key[0]:
                self._learn(data, starts[k : k + 1], ends[k : k + 1], np.zeros(1, np.int64), key)
                return int(self._probe(key)[0])
            if self._held(slot) == word:
                return slot

    def _held(self, slot: int) -> bytes:
        return self._bytes[self._begin[slot] : self._begin[slot] + self._size[slot]].tobytes()

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, some: np.ndarray, keys: np.ndarray) -> None:
        """Put these words, of different keys, into the table."""
        raw = [data[a:b].tobytes() for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)]
        self._add(keys[some], raw, *self._ids_of([r.decode(errors="replace") for r in raw]))

    def _gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words one after another, and where each word's end."""
        at, length = self._place[slots], self._length[slots].astype(np.int64)
        total = np.cumsum(length)
        return self._store[np.repeat(at - (total - length), length) + np.arange(total[-1])].astype("<u4"), total

    def _clear(self, least: int = 0) -> None:
        """An empty table for the known words, or for the words of one window if those are more."""
        size = 1 << max(10, (3 * max(self._limit, least) // 2).bit_length())
        self._keys, self._place = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self._length, self._store = np.zeros(size, np.int32), np.zeros(1 << 16, np.uint16)
        self._begin, self._size, self._bytes = np.zeros(size, np.int64), np.zeros(size, np.int32), np.zeros(1 << 16, np.uint8)
        self._value = np.zeros((size, self.values))
        self._words = self._stored = self._filled = 0

    def _probe(self, keys: np.ndarray) -> np.ndarray:
        """The slot that holds each key, or the free one where its search ends."""
        mask = np.uint64(len(self._keys) - 1)
        slots = (keys >> np.uint64(20)) & mask
        left = np.arange(len(keys))
        while True:
            there = self._keys[slots[left]]
            left = left[(there != keys[left]) & (there != 0)]
            if not len(left):
                return slots.astype(np.int64)
            slots[left] = (slots[left] + np.uint64(1)) & mask

    def _add(self, keys: np.ndarray, raw: list[bytes], ids: np.ndarray, lengths: np.ndarray, values: np.ndarray | None) -> None:
        sizes = np.array([len(r) for r in raw])
        places = self._stored + np.cumsum(lengths) - lengths
        begins = self._filled + np.cumsum(sizes) - sizes
        self._words, self._stored, self._filled = self._words + len(keys), self._stored + int(lengths.sum()), self._filled + int(sizes.sum())
        while self._stored > len(self._store):
            self._store = np.concatenate((self._store, np.zeros_like(self._store)))
        while self._filled > len(self._bytes):
            self._bytes = np.concatenate((self._bytes, np.zeros_like(self._bytes)))
        self._store[places[0] : self._stored] = ids
        self._bytes[begins[0] : self._filled] = np.frombuffer(b"".join(raw), np.uint8)
        left = np.arange(len(keys))
        while len(left):  # of the words that end at one free slot, one takes it
            slots = self._probe(keys[left])
            _, taken = np.unique(slots, return_index=True)
            put, slot = left[taken], slots[taken]
            self._keys[slot], self._place[slot], self._length[slot] = keys[put], places[put], lengths[put]
            self._begin[slot], self._size[slot] = begins[put], sizes[put]
            if values is not None:
                self._value[slot] = values[put]
            left = np.delete(left, taken)
