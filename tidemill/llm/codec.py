"""Token ids as bytes: an adaptive context-mixing range coder over independent runs.

Ids are cut into runs of at most 2,097,152. Each run starts from an empty model and carries
a checksum, so a damaged run is found and costs no other. A run is dealt to lanes of up to
512 ids that follow each other. All lanes share one model and are coded side by side, one
array element per lane, so a step costs little per id. The probability of the next id is a
weighted sum of three predictions:

- order 2: the id that last followed the two ids before it, by a hashed table,
- order 1: how often ids followed the id before it,
- order 0: how often ids occurred, once more than so far.

The weights are learned for each pair of the confidence that the order-2 prediction has
earned and of the number and variety of ids counted at order 1. Model and weights are renewed
from all ids coded so far after 1, 2, 4 ... 256 steps of all lanes; in between they rest, so
the encoder finds the places of all ids in whole arrays. Where several predictions hold an
id, the likeliest codes it. A range coder with 62-bit range writes 31-bit digits.

Format: magic, number of runs; then per run the number of ids, the crc32 of its ids as
little-endian 32-bit integers, the number of different ids, these as 16-bit integers, the
number of digits of each lane, and all digits.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TMX2"
BLOCK = 512  # most ids of a lane
LANES = 4096  # most lanes of a run

_BITS = 24  # of a probability
_ONE = 1 << _BITS
_DIGIT = 31
_LOW = (1 << _DIGIT) - 1
_SHARED = _ONE - (_ONE >> 7)  # most that order 1 and 2 may take together
_SLOTS0, _SLOTS1 = 1 << 14, 1 << 11  # counts are scaled down to about as many
_RENEW = (1, 2, 4, 8, 16, 32, 64, 128, 256)
_HASH_BITS = 17
_SURE = 4  # highest confidence
_LEVELS = 8  # room for confidences
_CLASSES = 40
_CHUNK = 4  # steps looked up at once


def _stages(length: int) -> list[tuple[int, int]]:
    cuts = [0, *(c for c in _RENEW if c < length), length]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _hash(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    return (last * 0x9E3779B1 + before * 0x85EBCA6B >> 20) & ((1 << _HASH_BITS) - 1)


def _starts(values: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return np.flatnonzero(new)


class _Model:
    """What the ids so far say about the next, the same on both sides.

    Ids are ranks among the different ids of the run, of `bits` bits. A place in the tables
    is confidence << bits | the id before. There `mass2` is order 2's share of `_ONE`, `upto`
    that of orders 2 and 1, `unit1` and `unit0` the share of one slot of orders 1 and 0, `row`
    the first slot of order 1.
    """

    def __init__(self, kinds: int):
        self.bits = max((kinds - 1).bit_length(), 1)
        self.mask = (1 << self.bits) - 1
        self.two = np.zeros(1 << _HASH_BITS, np.int64)  # confidence << bits | id
        self.counts = np.ones(kinds, np.int64)
        self.used = np.ones((_LEVELS * _CLASSES, 3), np.int64)  # by order 2, 1 and 0
        self.kind_of = np.zeros(1 << self.bits, np.int64)

    def renew(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Lay out the slots, given the pairs of ids seen so far, in order, and their counts."""
        seen = int(self.counts.sum())
        self.count0 = -(-self.counts * _SLOTS0 // seen) if seen > _SLOTS0 else self.counts
        ends = np.cumsum(self.count0)
        self.first0 = ends - self.count0

        before = (keys >> self.bits).astype(np.int64)
        at = _starts(before)
        names = before[at]
        kinds = np.diff(at, append=len(before))
        total = np.add.reduceat(counts, at) if len(at) else at
        each = np.repeat(total, kinds)
        self.count1 = np.where(each > _SLOTS1, -(-counts * _SLOTS1 // np.maximum(each, 1)), counts)
        first = np.cumsum(self.count1) - self.count1
        rows = first[at]
        self.first1 = first - np.repeat(rows, kinds)
        slots = np.add.reduceat(self.count1, at) if len(at) else at

        # Classes of order-1 rows: how many, and how varied, ids followed.
        variety = (4 * kinds < total).astype(np.int64) + (4 * kinds < 3 * total)
        size = np.minimum(np.frexp(total.astype(np.float64))[1], 12)
        self.kind_of[names] = 3 * size + variety - 2
        shares = _SHARED * self.used // self.used.sum(1, keepdims=True)
        shares = shares.reshape(_LEVELS, _CLASSES, 3)
        shares[0, :, 0] = 0
        share2, share1 = shares[:, self.kind_of, 0], shares[:, self.kind_of, 1]
        slots_of = np.zeros(1 << self.bits, np.int64)
        slots_of[names] = slots
        unit1 = share1 // np.maximum(slots_of, 1)
        self.mass2 = share2.ravel()
        self.upto = (share2 + unit1 * slots_of).ravel()
        self.unit1 = np.maximum(unit1, 1).ravel()
        self.unit0 = (_ONE - self.upto) // int(ends[-1])
        row = np.zeros(1 << self.bits, np.int64)
        row[names] = rows
        self.row = np.tile(row, _LEVELS)

    def learn(self, ids, last, hashes, guess, route) -> None:
        """Take in the ids of a stage; `guess` is what order 2 held, `route` 0, 1 or 2 as order
        2, 1 or 0 coded."""
        self.counts += np.bincount(ids, minlength=len(self.counts))
        sure = guess >> self.bits
        found = np.bincount((self.kind_of[last] + sure * _CLASSES) * 3 + route, minlength=self.used.size)
        self.used = self.used // 2 + found.reshape(self.used.shape) + 1
        one = 1 << self.bits
        right = guess & self.mask == ids
        kept = np.where(right, guess + (sure < _SURE) * one, guess - one)
        self.two[hashes] = np.where(right & (sure > 0) | (sure > 1), kept, ids | one)


class _Writer:
    def __init__(self, n: int, steps: int):
        self.low = np.zeros(n, np.int64)
        self.range = np.full(n, 1 << 2 * _DIGIT, np.int64)
        self.n = n
        self.digits = np.zeros((steps + 2) * n, np.int64)  # a row per place
        self.at = np.arange(n, dtype=np.int64)

    def put(self, start: np.ndarray, width: np.ndarray) -> None:
        unit = self.range >> _BITS
        self.low += start * unit
        np.multiply(width, unit, out=self.range)
        few = np.flatnonzero(self.range <= _LOW)
        low, at = self.low[few], self.at[few]
        self.digits[at] = low >> _DIGIT
        self.at[few] = at + self.n
        self.low[few] = (low & _LOW) << _DIGIT
        self.range[few] <<= _DIGIT

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Digits per lane, and all of them lane by lane."""
        self.digits[self.at] = self.low + _LOW >> _DIGIT
        sizes = self.at // self.n + 1
        most = int(sizes.max())
        table = self.digits[: most * self.n].reshape(most, self.n)
        for p in range(most - 1, 0, -1):  # carries
            table[p - 1] += table[p] >> _DIGIT
        own = np.arange(most) < sizes[:, None]
        return sizes.astype("<u4"), (table.T[own] & _LOW).astype("<u4")


class _Reader:
    def __init__(self, sizes: np.ndarray, digits: np.ndarray):
        ends = np.cumsum(sizes + 2)
        starts = ends - sizes - 2
        self.digits = np.zeros(int(ends[-1]), np.int64)  # each lane is followed by two zeros
        self.digits[np.arange(len(digits)) + np.repeat(np.arange(len(sizes)) * 2, sizes)] = digits
        self.at = starts + 2
        self.code = (self.digits[starts] << _DIGIT) | self.digits[starts + 1]
        self.range = np.full(len(sizes), 1 << 2 * _DIGIT, np.int64)

    def take(self, start: np.ndarray, width: np.ndarray, unit: np.ndarray) -> None:
        self.code -= start * unit
        np.multiply(width, unit, out=self.range)
        few = np.flatnonzero(self.range <= _LOW)
        at = self.at[few]
        self.code[few] = (self.code[few] << _DIGIT) | self.digits.take(at, mode="clip")
        self.at[few] = at + 1
        self.range[few] <<= _DIGIT


def _shape(size: int) -> tuple[int, int]:
    """Lanes of a run, and ids of each; the last are filled up with the lowest id."""
    n = -(-size // BLOCK)
    return n, -(-size // n)


def _encode_run(ids: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    n, length = _shape(len(ids))
    model, writer = _Model(kinds), _Writer(n, length)
    filled = np.zeros(n * length, np.int64)
    filled[: len(ids)] = ids
    table = np.zeros((length + 2, n), np.int64)  # a row per step, after two of zeros
    table[2:] = filled.reshape(n, length).T
    # All pairs in order, and which of them each step and lane has.
    order = ((table[1:-1] << model.bits | table[2:]) << 32).ravel()
    order |= np.arange(len(order))
    order = order.view(np.uint64)
    order.sort()
    pairs = (order >> 32).astype(np.uint32)
    begin = _starts(pairs)
    keys = pairs[begin]
    pair = np.empty(len(pairs), np.int32)
    order &= 0xFFFFFFFF
    pair[order.view(np.int64)] = np.repeat(np.arange(len(begin), dtype=np.int32), np.diff(begin, append=len(pairs)))
    pair = pair.reshape(length, n)
    del filled, order, pairs

    counts = np.zeros(len(keys), np.int64)
    count1, first1 = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for t0, t1 in _stages(length):
        seen = np.flatnonzero(counts)
        model.renew(keys[seen], counts[seen])
        count1[seen], first1[seen] = model.count1, model.first1
        hashes, guess, route = (np.empty((t1 - t0, n), np.int64) for _ in range(3))
        for t in range(t0, t1, _CHUNK):
            to = min(t + _CHUNK, t1)
            own, last = table[t + 2 : to + 2], table[t + 1 : to + 1]
            place = hashes[t - t0 : to - t0]
            place[:] = _hash(last, table[t:to])
            told = model.two[place]
            guess[t - t0 : to - t0] = told
            place = (told & ~model.mask) | last
            mass2, upto, unit0, unit1 = model.mass2[place], model.upto[place], model.unit0[place], model.unit1[place]
            at = pair[t:to]
            width1, width0 = count1[at] * unit1, model.count0[own] * unit0
            by1 = (width1 > width0) & (mass2 < upto)
            width = np.where(by1, width1, width0)
            by2 = (told & model.mask == own) & (mass2 > width)
            start = np.where(by1, mass2 + first1[at] * unit1, upto + model.first0[own] * unit0)
            start[by2] = 0
            width = np.where(by2, mass2, width)
            route[t - t0 : to - t0] = np.where(by2, 0, 2 - by1)
            for i in range(to - t):
                writer.put(start[i], width[i])
        if t1 < length:
            model.learn(*(a.ravel() for a in (table[t0 + 2 : t1 + 2], table[t0 + 1 : t1 + 1], hashes, guess, route)))
            counts += np.bincount(pair[t0:t1].ravel(), minlength=len(counts))
    return writer.finish()


def _decode_run(size: int, kinds: int, sizes: np.ndarray, digits: np.ndarray) -> np.ndarray:
    n, length = _shape(size)
    model, reader = _Model(kinds), _Reader(sizes, digits)
    table = np.zeros((length + 2, n), np.int64)
    keys, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    for t0, t1 in _stages(length):
        model.renew(keys, counts)
        # A slot says which id it stands for, the first slot of that id and their number.
        # Order 2 has a single one, and all orders one set of tables.
        one = (keys & model.mask).astype(np.int64) | model.first1 << 16 | model.count1 << 40
        none = np.arange(kinds) | model.first0 << 16 | model.count0 << 40
        slots = np.concatenate([[1 << 40], np.repeat(one, model.count1), np.repeat(none, model.count0)])
        base = np.full(len(model.row), 1 + int(model.count1.sum()))
        rows = np.concatenate([np.zeros_like(base), model.row + 1, base])
        units = np.concatenate([np.maximum(model.mass2, 1), model.unit1, model.unit0])
        begins = np.concatenate([np.zeros_like(base), model.mass2, model.upto])
        every = len(base)
        hashes, guess, route = (np.empty((t1 - t0, n), np.int64) for _ in range(3))
        for t in range(t0, t1):
            last = table[t + 1]
            at = hashes[t - t0]
            at[:] = _hash(last, table[t])
            told = model.two[at]
            guess[t - t0] = told
            place = (told & ~model.mask) | last
            unit = reader.range >> _BITS
            value = reader.code // unit
            order = route[t - t0]
            np.add(value >= model.mass2[place], value >= model.upto[place], out=order, dtype=np.int64)
            place += order * every
            each, start = units[place], begins[place]
            slot = (value - start) // each
            slot += rows[place]
            entry = slots.take(slot, mode="clip")
            start += (entry >> 16 & 0xFFFFFF) * each
            reader.take(start, (entry >> 40) * each, unit)
            ids = entry & 0xFFFF
            by2 = np.flatnonzero(order == 0)
            ids[by2] = told[by2] & model.mask
            table[t + 2] = ids
        if t1 < length:
            own, last = table[t0 + 2 : t1 + 2].ravel(), table[t0 + 1 : t1 + 1].ravel()
            model.learn(own, last, hashes.ravel(), guess.ravel(), route.ravel())
            found = (last << model.bits | own).astype(np.uint32)
            found.sort()
            at = _starts(found)
            both = np.concatenate([keys, found[at]]).astype(np.uint64) << 32
            both |= np.concatenate([counts, np.diff(at, append=len(found))]).astype(np.uint64)
            both.sort()
            keys = (both >> 32).astype(np.uint32)
            at = _starts(keys)
            counts = np.add.reduceat((both & 0xFFFFFFFF).astype(np.int64), at)
            keys = keys[at]
    return table[2:].T.ravel()[:size]


def encode(ids: np.ndarray) -> bytes:
    """Ids, each below 65,536, as bytes."""
    ids = np.ascontiguousarray(ids, "<u4")
    most = BLOCK * LANES
    out = [struct.pack("<4sI", MAGIC, -(-len(ids) // most))]
    if len(ids) and int(ids.max()) > 0xFFFF:
        raise ValueError("ids must be below 65536")
    for i in range(0, len(ids), most):
        run = ids[i : i + most]
        there = np.bincount(run) > 0
        names = np.flatnonzero(there)
        sizes, digits = _encode_run((np.cumsum(there) - 1)[run], len(names))
        out.append(struct.pack("<III", len(run), zlib.crc32(run.tobytes()), len(names)))
        out += [names.astype("<u2").tobytes(), sizes.tobytes(), digits.tobytes()]
    return b"".join(out)


def decode(data: bytes) -> np.ndarray:
    """The ids; raises ValueError if a run is damaged."""
    magic, n = struct.unpack_from("<4sI", data)
    if magic != MAGIC:
        raise ValueError("not a run of token ids")
    at, runs = 8, []

    def part(kind: str, count: int) -> np.ndarray:
        nonlocal at
        end = at + np.dtype(kind).itemsize * count
        if end > len(data):
            raise ValueError("token ids are cut off")
        found = np.frombuffer(data, kind, count, at)
        at = end
        return found

    for i in range(n):
        size, crc, kinds = part("<u4", 3).tolist()
        if not (0 < size <= BLOCK * LANES and 0 < kinds <= 1 << 16):
            raise ValueError(f"run {i} is damaged")
        names = part("<u2", kinds)
        sizes = part("<u4", _shape(size)[0]).astype(np.int64)
        with np.errstate(all="ignore"):  # damaged digits may lead anywhere
            found = _decode_run(size, kinds, sizes, part("<u4", int(sizes.sum())))
        ids = names.take(found, mode="clip").astype("<u4")
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"run {i} is damaged")
        runs.append(ids)
    return np.concatenate(runs) if runs else np.zeros(0, "<u4")
