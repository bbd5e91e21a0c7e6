"""An adaptive range coder for token ids: blocks that are reset and checksummed each, coded side by side.

A block's ids are coded one after another. Three tables predict the next id: from the two ids before (order 2), from
the id before (order 1) and from the ids so far (order 0, a majority vote); each prediction has a confidence that
grows with hits. Which of them is right, or none, is coded with probabilities mixed from two adaptive models, one
that knows the confidences and one that knows the last outcomes; the mixing weight follows the model that does better.
An id that none predicts is coded by its number of bits, with adaptive frequencies, and its lower bits as they are.

All blocks of a frame advance by one id at a time as numpy arrays, and all of them do the same steps: what only
concerns an id that none predicts is an empty step for the others. The last block is filled up with zeros. All
arithmetic is in whole numbers, so the decoder repeats the coder's steps exactly.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 1024
_SLOTS = 10  # bits of the prediction tables of a block
_ONE = 12  # bits of a probability
_LEAST = 2  # of the frequency of a number of bits
_TOP, _BOTTOM, _LOW = np.uint64(1 << 48), np.uint64(1 << 40), np.uint64((1 << 40) - 1)
_WORD = np.uint64(48)
_U = [np.uint64(i) for i in range(65)]


def _fields(*values: int) -> np.uint64:
    """Numbers of at most 16 bits in one word, the first in the lowest bits."""
    return np.uint64(sum(v << 16 * i for i, v in enumerate(values)))


# The four outcomes part at three places; these and the end of all stand in the fields of a word, so that each step of a
# model is one operation. What learning an outcome adds to each keeps them apart.
_EVEN = _fields(1 << 10, 2 << 10, 3 << 10, 4 << 10)
_LEARNT = np.array([_fields(*[k + 1 + 124 * (k >= outcome) for k in range(3)], 128) for outcome in range(4)])
_UPPER, _PART = _fields(*[0x7FF] * 4), _fields(*[0xFFF] * 4)
_EACH, _CARRY = _fields(1, 1, 1), _fields(*[1 << 15] * 3)
_FIELD, _INNER = np.uint64(0xFFFF), np.uint64(0xFFF)


def _bit_length(ids: np.ndarray) -> np.ndarray:
    """From the exponent of the floating-point number."""
    return np.maximum((ids.astype(np.float64).view(np.int64) >> 52) - 1022, 0)


class _Model:
    """Predictions and probabilities of all blocks; ids stand in the upper bits of a word, confidence in the lower two."""

    def __init__(self, blocks: int, bits: int):
        self.rows = np.arange(blocks, dtype=np.int64)
        self.base = np.stack([self.rows, self.rows + blocks]) << _SLOTS
        self.slots = self.base.copy()  # where the contexts of orders 2 and 1 are
        self.table = np.zeros(2 * blocks << _SLOTS, np.int32)
        self.words = np.zeros((3, blocks), np.int32)  # the predictions; the last is the vote
        self.before = np.zeros(blocks, np.uint32)
        self.sure, self.past = self.rows << 6, self.rows << 4
        self.by_sure, self.by_past = np.full(blocks << 6, _EVEN), np.full(blocks << 4, _EVEN)
        self.outcomes, self.weight = np.zeros(blocks, np.int64), np.full(blocks, 128, np.int16)
        n = bits + 1
        self.sizes = np.zeros((n + 1, blocks), np.int16)  # where the numbers of bits part
        self.sizes[1:n] = np.arange(1, n, dtype=np.int16)[:, None] * ((1 << _ONE) // n)
        self.sizes[n] = 1 << _ONE
        self.flat, self.goal = self.sizes.reshape(-1), np.empty((bits, blocks), np.int16)
        self.order = np.arange(1, n, dtype=np.int16)[:, None]
        self.most = np.int16((1 << _ONE) - n * _LEAST)

    def predict(self) -> np.ndarray:
        """The places where the four outcomes part."""
        self.table.take(self.slots, out=self.words[:2], mode="clip")
        sure = self.words & 3
        self.c1 = self.sure + ((sure[0] << 4) | (sure[1] << 2) | sure[2])
        self.c2 = self.past + self.outcomes
        self.p1, self.p2 = self.by_sure.take(self.c1), self.by_past.take(self.c2)
        weight = (self.weight >> 4).astype(np.uint64)
        return ((self.p1 * weight + self.p2 * (_U[16] - weight)) >> _U[4]) & _PART

    def learn(self, ids: np.ndarray, right: np.ndarray, outcome: np.ndarray) -> None:
        """``right``: which predictions were."""
        shift = outcome.astype(np.uint64) << _U[4]
        q1 = ((self.p1 - (self.p1 << _U[16])) >> shift) & _FIELD
        q2 = ((self.p2 - (self.p2 << _U[16])) >> shift) & _FIELD
        nearer = (q1 > q2).view(np.int8) - (q1 < q2).view(np.int8)
        self.weight = np.minimum(np.maximum(self.weight + (nearer << 1), np.int16(16)), np.int16(240))
        learnt = _LEARNT.take(outcome)
        self.by_sure[self.c1] = self.p1 - ((self.p1 >> _U[5]) & _UPPER) + learnt
        self.by_past[self.c2] = self.p2 - ((self.p2 >> _U[5]) & _UPPER) + learnt
        self.outcomes = ((self.outcomes & 3) << 2) | outcome
        words = self.words
        kept = -(right | ((words & 3) > 0)).view(np.int8).astype(np.int32)
        fresh, old = ids << 2, np.minimum(words + ((right.view(np.int8) << 1) - 1), words | 3)
        new = fresh ^ ((fresh ^ old) & kept)
        self.table[self.slots] = new[:2]
        self.words[2] = new[2]
        hashed = ids.view(np.uint32) * np.uint32(0x9E3779B1)
        shift = np.uint32(32 - _SLOTS)
        np.add(self.base[0], (hashed + self.before) >> shift, out=self.slots[0])
        np.add(self.base[1], hashed >> shift, out=self.slots[1])
        self.before = hashed * np.uint32(0x85EBCA6B)

    def interval(self, missed: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of the number of bits; everything where the id was predicted."""
        at = size * len(self.rows) + self.rows
        mask, whole = -missed.view(np.int8).astype(np.int16), np.int16(1 << _ONE)
        start = self.flat.take(at)
        width = ((self.flat.take(at + len(self.rows)) - start - whole) & mask) + whole
        return (start & mask).astype(np.uint64), width.astype(np.uint64)

    def size(self, target: np.ndarray) -> np.ndarray:
        found = self.sizes[1:-1] <= target.astype(np.int16)
        return np.add.reduce(found.view(np.uint8), axis=0, dtype=np.uint8)

    def learn_sizes(self, missed: np.ndarray, size: np.ndarray) -> None:
        inner, goal = self.sizes[1:-1], self.goal
        np.subtract(size.astype(np.int16), self.order, out=goal)
        goal >>= 15
        goal &= self.most
        goal += self.order * np.int16(_LEAST)
        goal -= inner
        goal >>= 5
        goal &= -missed.view(np.int8).astype(np.int16)
        inner += goal


def _interval(ends: np.ndarray, outcome: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and width of an outcome."""
    shift = outcome.astype(np.uint64) << _U[4]
    start = ((ends << _U[16]) >> shift) & _INNER
    return start, ((ends >> shift) - start) & _INNER


class _Coder:
    """Intervals of all blocks. A step narrows them and then moves finished bytes, two at once."""

    def __init__(self, blocks: int, room: int, source: np.ndarray | None = None):
        self.low, self.range = np.zeros(blocks, np.uint64), np.full(blocks, 2**64 - 1, np.uint64)
        self.decodes = source is not None
        self.words = source if self.decodes else np.zeros((blocks, room), np.uint16)
        self.flat = self.words.reshape(-1)
        self.base = np.arange(blocks) * self.words.shape[1]
        self.at = self.base.copy()
        if self.decodes:
            self.code = np.zeros(blocks, np.uint64)
            for i in range(4):
                self.code = (self.code << _U[16]) | self.words[:, i]
            self.at += 4

    def target(self) -> np.ndarray:
        """Where the codes lie in the unit interval, in steps of two probabilities."""
        found = (self.code - self.low) // (self.range >> _U[2 * _ONE])
        return np.minimum(found, np.uint64((1 << 2 * _ONE) - 1))

    def narrow(self, start: np.ndarray, width: np.ndarray, inner: np.ndarray, inner_width: np.ndarray) -> None:
        """To a part, and to a part of that."""
        unit = self.range >> _U[2 * _ONE]
        self.low += unit * ((start << _U[_ONE]) + width * inner)
        self.range = unit * (width * inner_width)

    def write_bits(self, value: np.ndarray, width: np.ndarray) -> None:
        self.range >>= width
        self.low += self.range * (value & ((_U[1] << width) - _U[1]))

    def read_bits(self, width: np.ndarray) -> np.ndarray:
        self.range >>= width
        value = np.minimum((self.code - self.low) // self.range, (_U[1] << width) - _U[1])
        self.low += self.range * value
        return value

    def move(self) -> None:
        same = (self.low ^ (self.low + self.range)) < _TOP
        small = self.range < _BOTTOM
        at = np.flatnonzero(small > same)
        if len(at):
            self.range[at] = (~self.low[at] + _U[1]) & _LOW
        moved = same | small
        shift = moved.view(np.uint8).astype(np.uint64) << _U[4]
        if self.decodes:
            word = self.flat.take(self.at) * moved
            self.code = (self.code << shift) | word
        else:
            self.flat[self.at] = (self.low >> _WORD).astype(np.uint16)  # again later, where nothing moved
        self.low <<= shift
        self.range <<= shift
        self.at += moved
        at = np.flatnonzero(((self.low ^ (self.low + self.range)) < _TOP) | (self.range < _BOTTOM))
        while len(at):
            here, wide, place = self.low[at], self.range[at], self.at[at]
            same = (here ^ (here + wide)) < _TOP
            wide = np.where(same, wide, (~here + _U[1]) & _LOW)
            if self.decodes:
                self.code[at] = (self.code[at] << _U[16]) | self.flat[place]
            else:
                self.flat[place] = (here >> _WORD).astype(np.uint16)
            self.at[at] = place + 1
            here, wide = here << _U[16], wide << _U[16]
            self.low[at], self.range[at] = here, wide
            at = at[((here ^ (here + wide)) < _TOP) | (wide < _BOTTOM)]

    def finish(self) -> None:
        for shift in (48, 32, 16, 0):
            self.flat[self.at] = (self.low >> _U[shift]).astype(np.uint16)
            self.at += 1


def encode(ids: np.ndarray, bits: int, block: int = BLOCK) -> tuple[bytes, list[int], list[int]]:
    """The coded blocks one after another, their lengths in bytes, their checksums. Ids have 1 to 28 ``bits``."""
    n = len(ids)
    if not n:
        return b"", [], []
    blocks, steps = -(-n // block), min(block, n)
    grid = np.zeros(blocks * steps, np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(blocks, steps).T)
    model, coder = _Model(blocks, bits), _Coder(blocks, steps * 4 + 8)
    for now in grid:
        ends = model.predict()
        right = (model.words >> 2) == now
        wrong = ~right
        second = wrong[0] & wrong[1]
        missed = second & wrong[2]
        outcome = wrong[0].view(np.uint8) + second.view(np.uint8) + missed.view(np.uint8)
        size = _bit_length(now)
        coder.narrow(*_interval(ends, outcome), *model.interval(missed, size))
        rest = (np.maximum(size - 1, 0) * missed).astype(np.uint64)
        value = now.astype(np.uint64)
        few = np.minimum(rest, _U[15])
        coder.write_bits(value, few)
        if bits > 16:
            coder.move()
            coder.write_bits(value >> few, rest - few)
        coder.move()
        model.learn(now, right, outcome)
        model.learn_sizes(missed, size)
    coder.finish()
    ends = coder.at - coder.base
    parts = [coder.words[i, :end].astype("<u2").tobytes() for i, end in enumerate(ends.tolist())]
    return b"".join(parts), [len(p) for p in parts], [zlib.crc32(p) for p in parts]


def decode(payload: bytes, lengths: list[int], checks: list[int], n: int, bits: int, block: int = BLOCK) -> np.ndarray:
    """The ids; raises if a block's checksum is wrong."""
    if not n:
        return np.empty(0, np.int64)
    blocks, steps, at = len(lengths), min(block, n), 0
    source = np.zeros((blocks, max(lengths) // 2 + 8), np.uint16)
    for i, (size, check) in enumerate(zip(lengths, checks, strict=True)):
        part = payload[at : at + size]
        if len(part) != size or zlib.crc32(part) != check:
            raise ValueError(f"block {i} is damaged")
        source[i, : size // 2] = np.frombuffer(part, "<u2")
        at += size
    model, coder = _Model(blocks, bits), _Coder(blocks, 0, source)
    out = np.zeros((steps, blocks), np.int32)
    for now in out:
        ends = model.predict()
        target = coder.target()
        passed = ((target >> _U[_ONE]) * _EACH + _CARRY - (ends & _fields(*[0xFFF] * 3))) & _CARRY
        outcome = ((((passed >> _U[15]) * _EACH) >> _U[32]) & _U[3]).astype(np.uint8)
        missed = outcome == 3
        start, width = _interval(ends, outcome)
        size = model.size((target - (start << _U[_ONE])) // width).astype(np.int64)
        coder.narrow(start, width, *model.interval(missed, size))
        rest = (np.maximum(size - 1, 0) * missed).astype(np.uint64)
        few = np.minimum(rest, _U[15])
        value = coder.read_bits(few)
        if bits > 16:
            coder.move()
            value |= coder.read_bits(rest - few) << few
        coder.move()
        new = (value | ((size > 0).astype(np.uint64) << rest)).astype(np.int32)
        known = model.words >> 2
        now[:] = np.concatenate([known, new[None]]).reshape(-1).take(outcome * np.int64(blocks) + model.rows)
        model.learn(now, known == now, outcome)
        model.learn_sizes(missed, size)
    return out.T.reshape(-1)[:n]
