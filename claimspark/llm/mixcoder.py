"""Adaptive context-mixing range coder for token ids, many blocks at a time (operator 4, the codec).

A block of ids is coded on its own: all models start anew.  For each id the
orders predict: order 2 (the last two ids) and order 1 each name the id that
followed last time, with a confidence.  Which of them is right, or neither,
is coded by a mix of three adaptive estimates (by order-2 confidence, by
order-1 confidence and by what happened lately).  An id that neither names
is coded by adaptive order-0 frequencies in three steps (6, 5 and 5 bits).
All predictions drive one carry-less range coder.

Blocks are lanes that step together; the arithmetic is in integers, so a
block is decoded alike in any company.
"""

from __future__ import annotations

import struct
import zlib
import numpy as np

MAGIC = b"IDM1"
HEADER = struct.Struct("<4sIII")
#: Bits of the tables of named ids, and of the contexts of the lowest bits: small, so that many lanes stay in cache.
SLOTS, CONTEXTS = 11, 9
_U64 = np.uint64
_TOP, _BOTTOM = _U64(1 << 48), _U64(1 << 32)

class RangeEncoder:
    def __init__(self, lanes: int, words: int):
        self.low, self.range = np.zeros(lanes, _U64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U64)
        self.out, self.at = np.zeros((lanes, words), np.uint16), np.zeros(lanes, np.int64)

    def code(self, lanes: np.ndarray, below: np.ndarray, size: np.ndarray, total: np.ndarray) -> None:
        """Take the part [below, below + size) of ``total`` of these lanes' ranges."""
        span = self.range[lanes] // total.astype(_U64)
        low = self.low[lanes] + span * below.astype(_U64)
        span *= size.astype(_U64)
        while True:
            self.low[lanes], self.range[lanes] = low, span
            same = (low ^ (low + span)) < _TOP
            need = np.flatnonzero(same | (span < _BOTTOM))
            if not len(need):
                return
            lanes, low, span, same = lanes[need], low[need], span[need], same[need]
            span = np.where(same, span, (_U64(0) - low) & (_BOTTOM - _U64(1))) << _U64(16)
            self._shift(lanes, low)
            low = low << _U64(16)

    def _shift(self, lanes: np.ndarray, low: np.ndarray) -> None:
        self.out[lanes, self.at[lanes]] = (low >> _U64(48)).astype(np.uint16)
        self.at[lanes] += 1

    def finish(self) -> list[bytes]:
        lanes = np.arange(len(self.low))
        for _ in range(4):
            self._shift(lanes, self.low)
            self.low <<= _U64(16)
        return [self.out[i, :k].astype("<u2").tobytes() for i, k in enumerate(self.at.tolist())]


class RangeDecoder(RangeEncoder):
    def __init__(self, blocks: list[bytes]):
        words = max(len(b) // 2 for b in blocks) + 8
        super().__init__(len(blocks), 1)
        self.data = np.zeros((len(blocks), words), np.uint16)
        for i, b in enumerate(blocks):
            self.data[i, :len(b) // 2] = np.frombuffer(b, "<u2")
        self.value = np.zeros(len(blocks), _U64)
        lanes = np.arange(len(blocks))
        for _ in range(4):
            self._shift(lanes, None)

    def _shift(self, lanes: np.ndarray, low: np.ndarray | None) -> None:
        at = np.minimum(self.at[lanes], self.data.shape[1] - 1)
        self.value[lanes] = self.value[lanes] << _U64(16) | self.data[lanes, at]
        self.at[lanes] += 1

    def target(self, lanes: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Where in ``total`` the coded part lies."""
        total = total.astype(_U64)
        at = (self.value[lanes] - self.low[lanes]) // (self.range[lanes] // total)
        return np.minimum(at, total - _U64(1)).astype(np.int64)


class Frequencies:
    """Adaptive frequencies of ``size`` symbols in each of many contexts, kept as running sums."""

    ADD, MOST = 24, 1 << 13

    def __init__(self, contexts: int, size: int):
        self.sums = np.empty((contexts, size), np.uint16)
        self.sums[:] = np.arange(1, size + 1)
        # What one more of a symbol adds to each running sum.
        self.more = np.triu(np.full((size, size), self.ADD, np.uint16))

    def encode(self, coder: RangeEncoder, lanes: np.ndarray, context: np.ndarray, symbol: np.ndarray) -> None:
        self._code(coder, lanes, context, symbol, self.sums[context])

    def decode(self, coder: RangeDecoder, lanes: np.ndarray, context: np.ndarray) -> np.ndarray:
        sums = self.sums[context]
        target = coder.target(lanes, sums[:, -1]).astype(np.uint16)
        symbol = np.add.reduce(sums <= target[:, None], axis=1, dtype=np.uint8).astype(np.int64)
        self._code(coder, lanes, context, symbol, sums)
        return symbol

    def _code(self, coder: RangeEncoder, lanes: np.ndarray, context: np.ndarray, symbol: np.ndarray,
              sums: np.ndarray) -> None:
        rows = np.arange(len(symbol))
        below = np.where(symbol > 0, sums[rows, symbol - 1], 0)
        coder.code(lanes, below, sums[rows, symbol] - below, sums[:, -1])
        sums += self.more[symbol]
        full = np.flatnonzero(sums[:, -1] > self.MOST)
        if len(full):
            sums[full] = ((np.diff(sums[full], axis=1, prepend=np.uint16(0)) >> 1) + 1).cumsum(axis=1)
        self.sums[context] = sums


class Mixed:
    """Which of three outcomes comes next in every lane: the mean of estimates in several contexts."""

    ONE = 1 << 14

    def __init__(self, lanes: int, contexts: tuple[int, ...]):
        self.sizes = contexts
        self.estimates = [np.full((lanes * c, 3), self.ONE // 3, np.int32) for c in contexts]
        self.targets = (np.eye(3) * self.ONE).astype(np.int32)

    def sizes_of(self, lane: np.ndarray, contexts: tuple[np.ndarray, ...]) -> np.ndarray:
        """Parts of the range for each outcome (columns)."""
        self.at = [lane * size + c for size, c in zip(self.sizes, contexts, strict=True)]
        self.rows = [e[a] for e, a in zip(self.estimates, self.at, strict=True)]
        return sum(self.rows[1:], self.rows[0]) + 16

    def learn(self, outcome: np.ndarray) -> None:
        target = self.targets[outcome]
        for e, a, rows in zip(self.estimates, self.at, self.rows, strict=True):
            e[a] = rows + ((target - rows) >> 4)


class _Model:
    """What all lanes know; the same steps run when encoding and when decoding."""

    def __init__(self, lanes: int):
        self.lane = np.arange(lanes)
        slots = lanes << SLOTS
        self.named = [np.full(slots, 65535, np.uint16) for _ in range(2)]
        self.sure = [np.zeros(slots, np.int8) for _ in range(2)]
        self.recent = np.zeros(lanes, np.int64)
        self.before, self.last = np.full(lanes, 65536, np.int64), np.full(lanes, 65537, np.int64)
        self.which = Mixed(lanes, (9, 16, 32))
        self.high, self.middle, self.lowest = Frequencies(lanes, 64), Frequencies(lanes * 64, 32), \
            Frequencies(lanes << CONTEXTS, 32)

    def names(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        mask = (1 << SLOTS) - 1
        one = (self.last[:n] * 40503 >> 4) & mask
        two = ((self.before[:n] * 69069 + self.last[:n] * 30011) >> 3) & mask
        self.slots = [(self.lane[:n] << SLOTS) | one, (self.lane[:n] << SLOTS) | two]
        first, second = (named[s] for named, s in zip(self.named, self.slots, strict=True))
        self.contexts = (self.recent[:n], self.sure[0][self.slots[0]].astype(np.int64),
                         self.sure[1][self.slots[1]] + 16 * (first == second))
        return first, second

    def learn(self, n: int, ids: np.ndarray, outcome: np.ndarray) -> None:
        for named, sure, slot in zip(self.named, self.sure, self.slots, strict=True):
            right = named[slot] == ids
            c = sure[slot]
            sure[slot] = np.where(right, np.minimum(c + 1, 15), c >> 1)
            named[slot] = np.where(right | (c > 2), named[slot], ids)
        self.recent[:n] = (self.recent[:n] * 3 + outcome) % 9
        self.before[:n], self.last[:n] = self.last[:n], ids


def _context(lanes: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Context of an id's lowest bits: its upper bits, several of which may share one."""
    return (lanes << CONTEXTS) | ((upper * 40503 >> 3) & ((1 << CONTEXTS) - 1))


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """A framed, checksummed code of each block of ids (below 65536)."""
    if not blocks:
        return []
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sizes = np.array([len(blocks[i]) for i in order], dtype=np.int64)
    ids = np.zeros((int(sizes.max()), len(blocks)), dtype=np.int64)
    for lane, i in enumerate(order):
        ids[:len(blocks[i]), lane] = blocks[i]
    coder, model = RangeEncoder(len(blocks), 5 * int(sizes.max()) + 16), _Model(len(blocks))
    for t in range(len(ids)):
        n = int(np.searchsorted(-sizes, -t, side="left"))
        x, lanes = ids[t, :n], model.lane[:n]
        first, second = model.names(n)
        outcome = np.where(second == x, 2, first == x)
        parts = model.which.sizes_of(lanes, model.contexts)
        sums = parts.cumsum(axis=1)
        size = parts[lanes, outcome]
        coder.code(lanes, sums[lanes, outcome] - size, size, sums[:, 2])
        model.which.learn(outcome)
        live = np.flatnonzero(outcome == 0)
        if len(live):
            y = x[live]
            model.high.encode(coder, live, live, y >> 10)
            model.middle.encode(coder, live, live * 64 + (y >> 10), y >> 5 & 31)
            model.lowest.encode(coder, live, _context(live, y >> 5), y & 31)
        model.learn(n, x, outcome)
    out: list[bytes] = [b""] * len(blocks)
    for i, code in zip(order, coder.finish(), strict=True):
        out[i] = HEADER.pack(MAGIC, len(blocks[i]), len(code), checksum(blocks[i])) + code
    return out


def decode_blocks(frames: list[bytes]) -> list[np.ndarray]:
    """The ids of each frame; a frame that is damaged raises ``ValueError``."""
    if not frames:
        return []
    heads = [HEADER.unpack_from(f) for f in frames]
    for (magic, _, length, _), frame in zip(heads, frames, strict=True):
        if magic != MAGIC or len(frame) != HEADER.size + length:
            raise ValueError("not a block of coded ids")
    order = sorted(range(len(frames)), key=lambda i: -heads[i][1])
    sizes = np.array([heads[i][1] for i in order], dtype=np.int64)
    coder, model = RangeDecoder([frames[i][HEADER.size:] for i in order]), _Model(len(frames))
    ids = np.zeros((int(sizes.max()), len(frames)), dtype=np.int64)
    for t in range(len(ids)):
        n = int(np.searchsorted(-sizes, -t, side="left"))
        lanes = model.lane[:n]
        first, second = model.names(n)
        parts = model.which.sizes_of(lanes, model.contexts)
        sums = parts.cumsum(axis=1)
        target = coder.target(lanes, sums[:, 2])
        outcome = (target >= sums[:, 0]).astype(np.int64) + (target >= sums[:, 1])
        size = parts[lanes, outcome]
        coder.code(lanes, sums[lanes, outcome] - size, size, sums[:, 2])
        model.which.learn(outcome)
        x = np.where(outcome == 2, second, first).astype(np.int64)
        live = np.flatnonzero(outcome == 0)
        if len(live):
            high = model.high.decode(coder, live, live)
            middle = model.middle.decode(coder, live, live * 64 + high)
            x[live] = high << 10 | middle << 5 | model.lowest.decode(
                coder, live, _context(live, high << 5 | middle))
        ids[t, :n] = x
        model.learn(n, x, outcome)
    out: list[np.ndarray] = [np.zeros(0, np.uint16)] * len(frames)
    for lane, i in enumerate(order):
        found = ids[:heads[i][1], lane].astype(np.uint16)
        if checksum(found) != heads[i][3]:
            raise ValueError("a block of coded ids fails its checksum")
        out[i] = found
    return out


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.asarray(ids).astype("<u4").tobytes())
