"""Adaptive context-mixing range coder for token ids, in independently reset, checksummed blocks.

A block's ids are dealt to lanes (contiguous stretches) that are coded side by side, one id of each lane a step,
under one model that starts empty and learns after every step from all lanes.  Three predictions are mixed into
one distribution over all ids, and an id is coded in one step under it:

* order 0: how often each id has come so far in the block;
* orders 1 and 2: the id that the last one or two ids lead to, all of its mass on that id.

The weights of the mixture are learned, per state of the predictions: how often each of the two has held of late,
and whether they agree.

A block: MAGIC, version, ids, lanes, documents, largest id + 1 (32-bit little endian each), CRC-32 of the ids and of
what follows; then per document its id (64 bits) and number of ids (32), per lane its number of 16-bit words (32),
and the lanes' words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, VERSION = b"QIDS", 2
HEAD = struct.Struct("<4s6I")
CRC = struct.Struct("<I")
#: Least ids of a lane, and most lanes of a block (a longer block has longer lanes); bits of the order-2 table.
STEPS, LANES, TABLE_BITS = 64, 4096, 18
#: Steps between sums of order 0, and from one step that the weights are learned from to the next (every one at first).
REFRESH, REWEIGH = 64, 4
#: Bits of the coder's range (whole numbers that a double holds), of a word, of the mixed distribution, and of order 0
#: in it (the rest are the weights').
RANGE_BITS, WORD_BITS, TOTAL_BITS, ZERO_BITS = 48, 16, 30, 19
HIGH_BITS = RANGE_BITS - WORD_BITS
_RANGE, _LEAST, _TOTAL = (1 << RANGE_BITS) - 1, 1 << HIGH_BITS, np.int32((1 << TOTAL_BITS) - 1)
SURE, SURE_BITS = 3, 2
#: First row of ``came`` for what was right: neither, order 1, order 2, both.
_EVENT = np.array([64, 32, 0, 0])
_MIX_LAST, _MIX_BEFORE = np.uint32(2654435761), np.uint32(2246822507)


class BlockError(ValueError):
    """A block that is not whole."""


class Model:
    """What a block's coder has learned so far; the same on both sides."""

    def __init__(self, size: int, lanes: int) -> None:
        self.zero_bits = max(ZERO_BITS, size.bit_length() + 2)
        if self.zero_bits > TOTAL_BITS - 4:
            raise ValueError(f"ids up to {size - 1} are too large")
        self.weight = 1 << (TOTAL_BITS - self.zero_bits)
        #: An order's guess: the id, and in the low bits how sure it is.
        self.two, self.one = np.zeros(1 << TABLE_BITS, np.int32), np.zeros(size, np.int32)
        #: Per state: how often order 2 was right, order 1 alone was, and neither.
        self.came = np.tile(np.array([[2], [2], [4]], np.int64), 32)
        self.counts, self.fresh = np.zeros(size, np.int64), []
        self.last = np.zeros(lanes, np.intp)
        self.key, self.key_before = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
        self.steps = 0
        self._sum()

    def _sum(self) -> None:
        """Order 0 from the counts: widths of at least 1 that add up to 2 ** zero_bits."""
        if self.fresh:
            self.counts += np.bincount(np.concatenate(self.fresh), minlength=len(self.counts))
            self.fresh = []
        whole = 1 << self.zero_bits
        self.wide = 1 + (self.counts * ((whole - len(self.counts)) / max(1, self.counts.sum()))).astype(np.int64)
        self.wide[self.wide.argmax()] += whole - self.wide.sum()
        self.below = (np.cumsum(self.wide) - self.wide).astype(np.int32)
        self.wide = self.wide.astype(np.int32)
        self.slots = None

    def predict(self) -> None:
        """Sets each lane's guesses and weights."""
        self.at = ((self.key * _MIX_LAST + self.key_before * _MIX_BEFORE) >> (32 - TABLE_BITS)).astype(np.intp)
        guess_two, guess_one = self.two[self.at], self.one[self.last]
        self.by_two, self.by_one = guess_two >> SURE_BITS, guess_one >> SURE_BITS
        self.sure_two, self.sure_one = guess_two & SURE, guess_one & SURE
        state = (self.sure_two << 3) + (self.sure_one << 1) + (self.by_two == self.by_one)
        self.state = state.astype(np.intp)
        self.weigh = self.steps < REFRESH or self.steps % REWEIGH == 0
        if self.weigh:
            shares = 1 + self.came[:2] * (self.weight - 3) // self.came.sum(axis=0)
            self.of_two, self.of_one = (shares << self.zero_bits).astype(np.int32)
            self.of_zero = (self.weight - shares.sum(axis=0)).astype(np.int32)
        self.mass_two, self.mass_one, self.weight_zero = self.of_two[self.state], self.of_one[self.state], self.of_zero[self.state]

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each lane's id lies in the mixed distribution: start and width."""
        small = self.small = ids.astype(np.int32)
        self.right_two, self.right_one = self.by_two == small, self.by_one == small
        start = self.weight_zero * self.below[ids] + self.mass_two * (self.by_two < small) + self.mass_one * (self.by_one < small)
        return start, self.weight_zero * self.wide[ids] + self.mass_two * self.right_two + self.mass_one * self.right_one

    def find(self, value: np.ndarray) -> np.ndarray:
        """The ids in whose intervals the values lie."""
        if self.slots is None:
            self.slots = np.repeat(np.arange(len(self.wide)), self.wide)
        a, b = np.minimum(self.by_two, self.by_one), np.maximum(self.by_two, self.by_one)
        mass_a = self.mass_two + (self.by_one < self.by_two) * (self.mass_one - self.mass_two)
        mass_b = self.mass_two + self.mass_one - mass_a
        # Take off what the value lies beyond of each guess's mass, so that order 0 is left.
        rest = value - self.weight_zero * self.below[b] - mass_a
        over_b = np.minimum(np.maximum(rest, 0), mass_b)
        over_a = np.minimum(np.maximum(value - self.weight_zero * self.below[a], 0), mass_a)
        return self.slots[((value - over_a - over_b) / self.weight_zero).astype(np.intp)]

    def learn(self, ids: np.ndarray) -> None:
        if self.weigh:
            event = _EVENT[2 * self.right_two + self.right_one]
            self.came += np.bincount(event + self.state, minlength=96).reshape(3, 32)
            if self.came.max() > 1 << 20:
                self.came = (self.came + 1) // 2
        new = (self.small << SURE_BITS) + 1  # a guess that was right is surer than before, up to SURE
        self.two[self.at] = new + self.right_two * np.minimum(self.sure_two, SURE - 1)
        self.one[self.last] = new + self.right_one * np.minimum(self.sure_one, SURE - 1)
        self.fresh.append(ids)
        self.steps += 1
        if self.steps % REFRESH == 0 or (self.steps < REFRESH and self.steps & (self.steps - 1) == 0):
            self._sum()
        self.last = ids
        self.key_before, self.key = self.key, ids.astype(np.uint32)


def _shape(n: int) -> tuple[int, int]:
    """Lanes and steps for n ids."""
    lanes = max(1, min(LANES, -(-n // STEPS)))
    return lanes, -(-n // lanes)


def _carry(out: np.ndarray, at: np.ndarray, lanes: int) -> None:
    """Adds one to the words of the same lanes before ``at``, and on to those before them."""
    while len(at):
        at = at - lanes
        out[at] += 1
        at = at[out[at] == 0]


def encode_ids(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """16-bit words of all lanes, one lane after another, and the lanes' numbers of words."""
    lanes, steps = _shape(len(ids))
    grid = np.zeros(lanes * steps, np.int32)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    room = steps * 2 + 4  # TOTAL_BITS a step at most
    out, lane = np.zeros(room * lanes, np.uint16), np.arange(lanes)  # a row has a word of each lane
    place = lane.copy()
    low, width = np.zeros(lanes, np.int64), np.full(lanes, 1 << RANGE_BITS)
    model = Model(size, lanes)
    for row in grid:
        now = row.astype(np.intp)
        model.predict()
        start, span = model.interval(now)
        unit = width >> TOTAL_BITS
        low += unit * start
        over = np.nonzero(low > _RANGE)[0]
        if len(over):
            _carry(out, place[over], lanes)
            low[over] &= _RANGE
        width = unit * span
        while len(short := np.nonzero(width < _LEAST)[0]):
            out[place[short]] = low[short] >> HIGH_BITS
            many = width < _LEAST
            place += many * lanes
            shift = many * WORD_BITS
            low = (low << shift) & _RANGE
            width <<= shift
        model.learn(now)
    last = low + (_LEAST - 1)  # one word names a number in what is left of the range
    _carry(out, place[last > _RANGE], lanes)
    out[place] = (last & _RANGE) >> HIGH_BITS
    used = place // lanes + 1
    return out.reshape(room, lanes).T[np.arange(room)[None, :] < used[:, None]], used


def decode_ids(words: np.ndarray, used: np.ndarray, n: int, size: int) -> np.ndarray:
    """The n ids that encode_ids() was given."""
    lanes, steps = _shape(n)
    room = int(used.max()) + 4
    padded = np.zeros((lanes, room), np.uint16)
    padded[np.arange(room)[None, :] < used[:, None]] = words
    padded = padded.T.ravel()  # a row has a word of each lane
    place = np.arange(lanes)
    beyond = np.zeros(lanes, np.int64)
    for _ in range(RANGE_BITS // WORD_BITS):  # how far the number lies beyond the low end of the range
        beyond = (beyond << WORD_BITS) | padded[place]
        place += lanes
    width = np.full(lanes, 1 << RANGE_BITS)
    model, grid = Model(size, lanes), np.zeros((steps, lanes), np.int32)
    for row in grid:
        model.predict()
        unit = width >> TOTAL_BITS
        # Exact: the quotient's fraction is 0 or at least 1 / unit, more than a double rounds off.
        value = np.minimum((beyond / unit).astype(np.int32), _TOTAL)
        now = model.find(value)
        start, span = model.interval(now)
        row[:] = now
        beyond -= unit * start
        width = unit * span
        while (many := width < _LEAST).any():
            shift = many * WORD_BITS
            beyond = (beyond << shift) | (padded[place] * many)
            place += many * lanes
            width <<= shift
        model.learn(now)
    return grid.T.ravel()[:n]


def pack(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A block of whole documents."""
    size = int(ids.max()) + 1 if len(ids) else 1
    words, used = encode_ids(ids, size) if len(ids) else (np.zeros(0, np.uint16), np.zeros(0, np.int64))
    body = doc_ids.astype("<i8").tobytes() + counts.astype("<u4").tobytes() + used.astype("<u4").tobytes() + words.astype("<u2").tobytes()
    head = HEAD.pack(MAGIC, VERSION, len(ids), len(used), len(doc_ids), size, zlib.crc32(ids.astype("<u4").tobytes()))
    return head + CRC.pack(zlib.crc32(body, zlib.crc32(head))) + body


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, counts, ids) of a block; BlockError if anything in it was changed."""
    if len(block) < HEAD.size + CRC.size:
        raise BlockError("too short")
    magic, version, n, lanes, docs, size, crc = HEAD.unpack_from(block)
    head, body = block[: HEAD.size], block[HEAD.size + CRC.size :]
    if magic != MAGIC or version != VERSION or zlib.crc32(body, zlib.crc32(head)) != CRC.unpack_from(block, HEAD.size)[0]:
        raise BlockError("not a block, or changed")
    doc_ids = np.frombuffer(body, "<i8", docs)
    counts = np.frombuffer(body, "<u4", docs, docs * 8).astype(np.int64)
    used = np.frombuffer(body, "<u4", lanes, docs * 12).astype(np.int64)
    words = np.frombuffer(body, "<u2", int(used.sum()), docs * 12 + lanes * 4)
    ids = decode_ids(words, used, n, size) if n else np.zeros(0, np.int64)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise BlockError("the ids differ")
    return doc_ids, counts, ids
