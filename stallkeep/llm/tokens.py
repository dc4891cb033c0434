"""Token ids of a byte-level BPE, with a table of known words."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from stallkeep.llm.wordtable import WINDOW, WordTable

_SPACE, _LINE = 32, 10


class ByteBpe(WordTable):
    """Ids of whole texts, as little-endian unsigned 32-bit bytes.

    A byte-level BPE cuts a text into words first and merges inside each, so a
    text is the concatenation of its words' ids. Texts whose white space is
    single spaces and line ends (nearly all) are cut there with array
    operations, and the ids of a word come from a bounded table under a 64-bit
    hash of its bytes; the tokenizer sees words that are not in the table, and
    whole texts where white space meets in another way. Both ways give the ids
    of ``encode`` on the text. A null text counts as empty. Strings of special
    tokens inside a text are ordinary text. Ids must be below 65,536.
    """

    def __init__(self, path: str, known_words: int = 2_000_000):
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        if self._tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids beyond 65,535")
        self._line_end = int(np.frombuffer(self.whole(["\n"])[0], "<u4")[0])
        super().__init__(known_words)

    @staticmethod
    @lru_cache(maxsize=2)
    def shared(path: str) -> ByteBpe:
        """One encoder for all tasks that a Python worker runs."""
        return ByteBpe(path)

    def whole(self, texts: Sequence[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def decode(self, ids: Sequence[int]) -> str:
        return self._tokenizer.decode([int(i) for i in ids], skip_special_tokens=False)

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        raw = [(t or "").encode() for t in texts]
        out: list[bytes] = []
        start = 0
        while start < len(raw):  # windows of texts; one beyond the window goes whole
            end, size = start, 0
            while end < len(raw) and size + len(raw[end]) < WINDOW:
                size += len(raw[end])
                end += 1
            if end == start:
                out += self.whole([texts[start]])
                start += 1
            else:
                out += self._window(raw[start:end])
                start = end
        return out

    def _window(self, raw: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"".join(raw), np.uint8)
        sizes = np.array([len(r) for r in raw])
        edges = np.concatenate(([0], np.cumsum(sizes)))
        if not len(data):
            return [b""] * len(raw)
        line = data == _LINE
        begins = (data == _SPACE) | line
        begins[1:] |= line[:-1]
        begins[edges[:-1][sizes > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        ids, total = self._gather(self._find(data, starts, ends))
        bounds = np.concatenate(([0], total))[np.searchsorted(starts, edges)]
        out = [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        odd = np.flatnonzero(_uneven(data, edges))
        for i, found in zip(odd, self.whole([raw[i].decode() for i in odd]), strict=True):
            out[i] = found
        return out

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, None]:
        """Ids of single words, from texts of many lines: a line end between two words is an id of its own."""
        ids, lengths = [], []
        for at in range(0, len(words), 20_000):
            some = words[at : at + 20_000]
            if all(w.strip() for w in some):
                found = np.frombuffer(self.whole(["\n".join(some)])[0], "<u4")
                cuts = np.flatnonzero(found == self._line_end)
                if len(cuts) + 1 == len(some):
                    ids.append(np.delete(found, cuts))
                    lengths.append(np.diff(cuts, prepend=-1, append=len(found)) - 1)
                    continue
            parts = self.whole(some)
            ids.append(np.frombuffer(b"".join(parts), "<u4"))
            lengths.append(np.array([len(p) // 4 for p in parts]))
        return np.concatenate(ids), np.concatenate(lengths), None


def _uneven(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Texts in which words cannot stand alone: white space other than space and
    line end, or white space next to white space, but for two line ends inside."""
    space, line = data == _SPACE, data == _LINE
    white = space | line
    bad = ((data >= 9) & (data <= 13) & ~line) | ((data >= 28) & (data <= 31))
    for lead in (0xC2, 0xE1, 0xE2, 0xE3):
        at = np.flatnonzero(data == lead)
        at = at[at + 2 < len(data)] if lead != 0xC2 else at[at + 1 < len(data)]
        one = data[at + 1]
        if lead == 0xC2:
            hit = (one == 0x85) | (one == 0xA0)
        else:
            two = data[at + 2]
            hit = {
                0xE1: (one == 0x9A) & (two == 0x80),
                0xE2: ((one == 0x80) & ((two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF))) | ((one == 0x81) & (two == 0x9F)),
                0xE3: (one == 0x80) & (two == 0x80),
            }[lead]
        bad[at[hit]] = True
    owner_starts = edges[:-1]
    inside = np.ones(len(data), bool)
    inside[owner_starts[owner_starts < len(data)]] = False
    pair = np.flatnonzero(white[1:] & white[:-1] & inside[1:]) + 1  # second of two, in one text
    lines = line[pair] & line[pair - 1]
    bad[pair[~lines]] = True
    pair = pair[lines]
    last = np.zeros(len(data) + 1, bool)
    last[edges[1:]] = True
    runs = np.isin(pair + 1, pair) | last[pair + 1] | (~inside[pair - 1])
    bad[pair[runs]] = True
    count = np.concatenate(([0], np.cumsum(bad)))
    return count[edges[1:]] > count[edges[:-1]]
