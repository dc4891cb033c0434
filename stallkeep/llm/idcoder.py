"""A context-mixing range coder for token ids, many blocks at a time.

Ids below 65,535 are cut into blocks of ``BLOCK``. Each block starts from a
reset model and can be decoded alone. For every id the order-2 and the order-1
context name the id that followed them last; learnt hit rates of both, by how
often they were right in a row, are mixed with the order-0 distribution of the
segment into one interval, which a carry-less 64-bit range coder with 32-bit
words takes. Blocks are independent, so one numpy step handles one id of every
block. The decoder steps through the model (``_Model``); the encoder knows all
ids, so it sorts what the tables would have held by context (``_foreseen``) and
steps through rates and intervals only. Both come to the same numbers.

Segment, little endian: magic, number of ids, of blocks, length of the
order-0 table, crc32 of that table; the table (zlib: ids as differences, then
frequencies summing to 2**18); per block its number of words and the crc32 of
their bytes; the words of all blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence

import numpy as np

BLOCK = 4096
MAX_ID = 65_534

_MAGIC = b"SKI2"
_HEAD = struct.Struct("<4sQIII")
_SLOTS = 10  # bits of a context table
_MASK = (1 << _SLOTS) - 1
_ORDER0 = 18  # bits of the order-0 total
_TOTAL = 12 + _ORDER0  # bits of the whole distribution
_CERTAIN, _RARE = 4032, 64  # of 4096: bounds of a rate, so that no interval is empty
_NONE = 0xFFFF  # an id that no text has
_STEPS = 32  # steps of the encoder whose intervals are computed together
_LANES = 64  # blocks whose contexts are sorted together
_U = np.uint64
_LOW32 = _U(0xFFFFFFFF)


def _slots(last: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (last * 40503 >> 7) & _MASK, (context + last * 2654435761 >> 15) & _MASK


class _Model:
    """Order-1 and order-2 predictions of n blocks side by side.

    A table entry is the id that came last behind a context and, above 16 bits,
    how often in a row it was right (0 to 3); NONE where nothing was seen.
    """

    def __init__(self, n: int):
        self.tables = [np.full(n << _SLOTS, _NONE, np.int32) for _ in range(2)]
        self.rates = [np.full(4 * n, p, np.int32) for p in (1024, 2048)]
        self.base = np.arange(n, dtype=np.int64) << _SLOTS
        self.lane4 = np.arange(n, dtype=np.int32) * 4
        self.last, self.context = np.zeros(n, np.uint32), np.zeros(n, np.uint32)

    def predict(self, n: int) -> None:
        last, base, lane4 = self.last[:n], self.base[:n], self.lane4[:n]
        slot1, slot2 = _slots(last, self.context[:n])
        self.at1, self.at2 = base + slot1, base + slot2
        self.entry1, self.entry2 = self.tables[0].take(self.at1), self.tables[1].take(self.at2)
        self.times1, self.times2 = self.entry1 >> 16, self.entry2 >> 16
        self.rate1, self.rate2 = lane4 + self.times1, lane4 + self.times2
        self.id1, self.id2 = self.entry1 & 0xFFFF, self.entry2 & 0xFFFF
        self.old1, self.weight2 = self.rates[0].take(self.rate1), self.rates[1].take(self.rate2)
        weight1 = (4096 - self.weight2) * self.old1 >> 12
        weight1 *= self.id1 != self.id2
        self.weight1, self.both = weight1, weight1 + self.weight2

    def update(self, ids: np.ndarray, n: int) -> None:
        """The order-1 rate is that of the ids which order 2 misses."""
        right1, right2 = self.id1 == ids, self.id2 == ids
        moved = right1 * np.int32(_CERTAIN - _RARE)
        moved += _RARE
        moved -= self.old1
        moved >>= 4
        moved *= ~right2
        moved += self.old1
        self.rates[0][self.rate1] = moved
        moved = right2 * np.int32(_CERTAIN - _RARE)
        moved += _RARE
        moved -= self.weight2
        moved >>= 4
        moved += self.weight2
        self.rates[1][self.rate2] = moved
        first = ids + np.int32(65536)
        for table, at, times, right in ((self.tables[0], self.at1, self.times1, right1), (self.tables[1], self.at2, self.times2, right2)):
            more = np.minimum(times, 2)
            more *= right
            more <<= 16
            more += first
            table[at] = more
        np.multiply(self.last[:n], np.uint32(40503), out=self.context[:n])
        self.last[:n] = ids


def _order0(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur and their frequencies, at least 1 each, of 2**18 in all."""
    counts = np.bincount(ids, minlength=1)
    present = np.flatnonzero(counts)
    total = 1 << _ORDER0
    scaled = 1 + (counts[present] * (total - len(present)) // max(1, len(ids))).astype(np.int64)
    if len(present):
        scaled[np.argmax(scaled)] += total - scaled.sum()
    return present, scaled


def encode(ids: np.ndarray) -> bytes:
    """A segment of these ids. No ids give a segment without blocks; an id beyond MAX_ID raises."""
    ids = np.asarray(ids, dtype=np.int64)
    if len(ids) and not 0 <= ids.min() <= ids.max() <= MAX_ID:
        raise ValueError(f"ids must lie in 0..{MAX_ID}")
    present, scaled = _order0(ids)
    table = zlib.compress(np.concatenate((np.diff(present, prepend=0), scaled)).astype("<u4").tobytes(), 6)
    n = -(-len(ids) // BLOCK)
    words, used = _encode_blocks(ids, n, present, scaled)
    bodies = [words[k, : used[k]].astype("<u4").tobytes() for k in range(n)]
    index = np.array([(len(b) // 4, zlib.crc32(b)) for b in bodies], dtype="<u4").reshape(-1, 2)
    return b"".join([_HEAD.pack(_MAGIC, len(ids), n, len(table), zlib.crc32(table)), table, index.tobytes(), *bodies])


def _by_step(ids: np.ndarray, n: int) -> np.ndarray:
    padded = np.zeros(n * BLOCK, np.uint16)
    padded[: len(ids)] = ids
    return np.ascontiguousarray(padded.reshape(n, BLOCK).T)


def _encode_blocks(ids: np.ndarray, n: int, present: np.ndarray, scaled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not n:
        return np.zeros((0, 0), np.uint32), np.zeros(0, np.int64)
    frequency = np.zeros(int(present[-1]) + 1, np.int64)
    frequency[present] = scaled
    before = np.concatenate(([0], np.cumsum(frequency)))[:-1]
    steps = _by_step(ids, n)
    seen = _foreseen(steps)
    rates1, rates2 = (np.full(4 * n, p, np.int32) for p in (1024, 2048))
    lane4 = np.arange(n, dtype=np.int32) * 4
    short = len(ids) - (n - 1) * BLOCK
    low, span = np.zeros(n, _U), np.full(n, 0xFFFFFFFFFFFFFFFF, _U)
    out, used = np.zeros((n, BLOCK + 8), np.uint32), np.zeros(n, np.int64)  # a word an id at most
    last = min(BLOCK, len(ids))
    edges = sorted({*range(0, last, _STEPS), short, last})
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        live = n if a < short else n - 1
        some = seen[a:b, :live].astype(np.int32)
        at1, at2 = lane4[:live] + (some & 3), lane4[:live] + (some >> 2 & 3)
        right1, right2 = (some & 16).astype(bool), (some & 32).astype(bool)
        goal1, goal2 = (r * np.int32(_CERTAIN - _RARE) + np.int32(_RARE) for r in (right1, right2))
        missed = (~right2).astype(np.int32)
        old1, weight2 = np.empty(some.shape, np.int32), np.empty(some.shape, np.int32)
        for k in range(b - a):
            one, two, moved = old1[k], weight2[k], goal1[k]
            rates1.take(at1[k], out=one, mode="clip")
            rates2.take(at2[k], out=two, mode="clip")
            moved -= one
            moved >>= 4
            moved *= missed[k]
            moved += one
            rates1[at1[k]] = moved
            moved = goal2[k]
            moved -= two
            moved >>= 4
            moved += two
            rates2[at2[k]] = moved
        weight1 = ((4096 - weight2) * old1 >> 12) * (some >> 6)
        both = (weight1 + weight2).astype(np.int64)
        now = steps[a:b, :live]
        rest = 4096 - both
        shift = 1 << _ORDER0
        start = np.where(right2, 0, np.where(right1, weight2.astype(np.int64) * shift, before.take(now) * rest + (both << _ORDER0))).view(_U)
        width = np.where(right2, weight2.astype(np.int64) * shift, np.where(right1, weight1.astype(np.int64) * shift, frequency.take(now) * rest)).view(_U)
        for k in range(b - a):
            each = span[:live] >> _U(_TOTAL)
            low[:live] += each * start[k]
            np.multiply(each, width[k], out=span[:live])
            at, moved = _narrowed(low[:live], span[:live])
            to = used[at]
            out[at, to] = moved >> _U(32)
            used[at] = to + 1
    for _ in range(2):
        out[np.arange(n), used] = low >> _U(32)
        used += 1
        low <<= _U(32)
    return out, used


def _foreseen(steps: np.ndarray) -> np.ndarray:
    """What the model's tables say before each id, for ids by step and block.

    Bits 0 and 1: how often in a row the order-1 entry was right; 2 and 3: the
    same of order 2; 4 and 5: whether they are right; 6: whether they differ. An
    entry is the id at the last place with the same slot.
    """
    out = np.empty(steps.shape, np.uint8)
    for lane in range(0, steps.shape[1], _LANES):
        ids = np.ascontiguousarray(steps[:, lane : lane + _LANES].T)
        # 32 bits hold all bits of the slots.
        last, older = np.zeros(ids.shape, np.uint32), np.zeros(ids.shape, np.uint32)
        last[:, 1:], older[:, 2:] = ids[:, :-1], ids[:, :-2]
        rows = np.arange(len(ids))[:, None] * ids.shape[1]
        both = []
        for k, slots in enumerate(_slots(last, older * np.uint32(40503))):
            slots = slots.astype(np.uint16)
            order = np.argsort(slots, axis=1, kind="stable")
            order += rows
            slot, value = slots.take(order), ids.take(order)
            known, right = np.zeros(ids.shape, bool), np.zeros(ids.shape, bool)
            known[:, 1:] = slot[:, 1:] == slot[:, :-1]
            right[:, 1:] = known[:, 1:] & (value[:, 1:] == value[:, :-1])
            times = known.astype(np.uint8)
            times[:, 1:] += known[:, 1:] & right[:, :-1]
            times[:, 2:] += known[:, 2:] & right[:, 1:-1] & right[:, :-2]
            entry = np.full(ids.shape, _NONE, np.uint32)
            np.copyto(entry[:, 1:], value[:, :-1], where=known[:, 1:])
            entry |= (times << 2 * k | right.view(np.uint8) << 4 + k).astype(np.uint32) << 16
            back = np.empty(ids.shape, np.uint32)
            back.reshape(-1)[order] = entry
            both.append(back)
        one, two = both
        differ = (one & 0xFFFF) != (two & 0xFFFF)
        out[:, lane : lane + _LANES] = ((one | two) >> 16).astype(np.uint8).T | differ.T.view(np.uint8) << 6
    return out


def _narrowed(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Widen spans below 32 bits by a word, after which they are wide again.

    A span that reaches over a word border is cut there first, so the upper word
    is known. Returns the blocks concerned and their lows from before.
    """
    at = np.flatnonzero(span < _U(1 << 32))
    some, narrow = low[at], span[at]
    over = np.flatnonzero((some ^ (some + (narrow - _U(1)))) > _LOW32)
    narrow[over] = (~some[over] + _U(1)) & _LOW32
    low[at] = some << _U(32)
    span[at] = narrow << _U(32)
    return at, some


def decode(segment: bytes, blocks: Sequence[int] | None = None) -> np.ndarray:
    """The ids of a segment, or of some of its blocks one after another.

    Raises ValueError where the magic, the table or a block fails its check.
    """
    magic, total, n, table_size, table_crc = _HEAD.unpack_from(segment)
    table = segment[_HEAD.size : _HEAD.size + table_size]
    if magic != _MAGIC or zlib.crc32(table) != table_crc:
        raise ValueError("no id segment, or its order-0 table is damaged")
    at = _HEAD.size + table_size
    index = np.frombuffer(segment, "<u4", 2 * n, at).reshape(n, 2).astype(np.int64)
    ends = at + 8 * n + 4 * np.cumsum(index[:, 0])
    chosen = list(range(n)) if blocks is None else list(blocks)
    if not chosen:
        return np.zeros(0, np.uint16)
    words = np.zeros((len(chosen), int(index[chosen, 0].max()) + 2), np.uint32)
    for row, k in enumerate(chosen):
        body = segment[ends[k] - 4 * index[k, 0] : ends[k]]
        if zlib.crc32(body) != index[k, 1]:
            raise ValueError(f"block {k} is damaged")
        words[row, : index[k, 0]] = np.frombuffer(body, "<u4")
    present, scaled = np.split(np.frombuffer(zlib.decompress(table), "<u4").astype(np.int64), 2)
    lengths = np.array([min(BLOCK, total - k * BLOCK) for k in chosen])
    order = np.argsort(-lengths, kind="stable")
    decoded = _decode_blocks(words[order], lengths[order], np.cumsum(present), scaled)
    return np.concatenate([decoded[np.flatnonzero(order == row)[0], : lengths[row]] for row in np.flatnonzero(lengths)]) if blocks else decoded.reshape(-1)[:total]


def _decode_blocks(words: np.ndarray, lengths: np.ndarray, present: np.ndarray, scaled: np.ndarray) -> np.ndarray:
    """Blocks, longest first, as rows."""
    n = len(words)
    frequency = np.zeros(int(present[-1]) + 1, np.int64)
    frequency[present] = scaled
    slots = np.repeat(present.astype(np.uint16), scaled)
    before = np.concatenate(([0], np.cumsum(frequency)))[:-1]
    model = _Model(n)
    low, span, code = np.zeros(n, _U), np.full(n, 0xFFFFFFFFFFFFFFFF, _U), np.zeros(n, _U)
    for k in range(2):
        code = (code << _U(32)) | words[:, k]
    used = np.full(n, 2, np.int64)
    out = np.zeros((BLOCK, n), np.uint16)
    for step in range(int(lengths[0])):
        live = n if step < lengths[-1] else int(np.searchsorted(-lengths, -step, "left"))
        model.predict(live)
        each = span[:live] >> _U(_TOTAL)
        value = np.minimum((code[:live] - low[:live]) // each, _U((1 << _TOTAL) - 1)).view(np.int64)
        event = (value >> _ORDER0).astype(np.int32)
        second = event < model.weight2
        now = np.where(second, model.id2, model.id1)
        start = np.where(second, 0, model.weight2).astype(np.int64)
        width = np.where(second, model.weight2, model.weight1).astype(np.int64)
        start <<= _ORDER0
        width <<= _ORDER0
        literal = np.flatnonzero(event >= model.both)
        both = model.both[literal].astype(np.int64)
        rest = 4096 - both
        both <<= _ORDER0
        ids = slots[(value[literal] - both) // rest]
        now[literal] = ids
        start[literal] = before.take(ids) * rest + both
        width[literal] = frequency.take(ids) * rest
        low[:live] += each * start.view(_U)
        np.multiply(each, width.view(_U), out=span[:live])
        model.update(now, live)
        out[step, :live] = now
        at, _ = _narrowed(low[:live], span[:live])
        to = used[at]
        code[at] = (code[at] << _U(32)) | words[at, to]
        used[at] = to + 1
    return np.ascontiguousarray(out.T)
