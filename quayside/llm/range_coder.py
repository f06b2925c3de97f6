"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks; every block starts from an empty model and carries a
crc32 of its ids.  A segment lists its distinct ids by falling frequency, and a
block codes ranks in that list.  For each rank the model mixes three
predictions into one distribution: the rank that last followed the two before
(order 2), the rank that last followed the one before (order 1), and
frequencies (order 0).  The order-2 and order-1 ranks get as much of the range
as they were right so far in this block at their present confidence.  Order 0
shares the rest: ranks fall into classes, four for each doubling of the rank,
whose frequencies are the block's; the 2^j ranks of a class share its part
evenly.  Shares and frequencies are renewed every ``_PERIOD`` steps.

A block is coded as ``STREAMS`` runs of its ids side by side, each with its own
range coder (a 63-bit window that puts out 32 bits at a time, carries go back
into units put out before) and all with the block's one model.  Blocks are
independent, so a segment's blocks go side by side too: one id of every stream
of every block is a step, in numpy lanes.  The tables of a block are small: it
holds no row as long as the vocabulary.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 8192
LANES = 512
STREAMS = 32
_MAGIC, _HEAD, _BLOCK_HEAD = b"QTOK", struct.Struct("<4sHHIIII"), struct.Struct(f"<II{STREAMS}H")
_VERSION = 2
_BITS = 16                              # the range is dealt out in 2^16 parts
_ALL = 1 << _BITS
_LEAST = _ALL >> 6                      # parts that order 0 keeps at least
_FINE = 10                              # class frequencies of a block sum to 2^10
_CONTEXTS, _HASH = 1 << 13, 32 - 13     # of a block and an order
_PERIOD = 32                            # steps between renewals, fewer at first
_MOST_IDS = 1 << 18                     # then any part is 2^-31 of the range or more
_U = np.uint64
_LOW, _FULL = _U((1 << 31) - 1), _U((1 << 63) - 1)


class _Model:
    """The state of ``n`` blocks of ``STREAMS`` lanes; ranks count from 4, so that class ``c``
    holds the ``2 ** (c // 4)`` ranks from ``4 + c % 4 << c // 4`` on.  Per order, ``last``
    holds rank * 4 + confidence for each context; ``seen`` counts by both confidences what
    coded the rank (order 0, 1 or 2), ``used`` the classes of order 0."""

    def __init__(self, n: int, n_ids: int):
        rank = np.arange(4 + n_ids)
        up = np.maximum(np.frexp(rank.astype(float))[1] - 3, 0)
        self.of = (4 * up + (rank >> up) - 4).astype(np.int32)
        self.n, self.c, self.top = n, int(self.of[-1]) + 1, np.int32(3 + n_ids)
        block = np.arange(n * STREAMS, dtype=np.int32) // np.int32(STREAMS)
        self.contexts, self.states, self.rows, self.finely = (block * np.int32(size) for size in (_CONTEXTS, 16, self.c, 1 << _FINE))
        self.last = [np.zeros(n * _CONTEXTS, np.int32) for _ in range(2)]
        self.before = [np.zeros(n * STREAMS, np.uint32) for _ in range(2)]   # last rank, the one before
        self.seen, self.used = np.zeros((n, 4, 4, 3), np.int64), np.zeros((n, self.c), np.int64)
        self.log = np.empty((2, _PERIOD, n * STREAMS), np.int32)
        self.t = self.logged = self.next = 0

    def _renew(self) -> None:
        for log, seen in zip(self.log, (self.seen, self.used), strict=True):
            seen += np.bincount(log[:self.logged].ravel(), minlength=seen.size + 1)[:seen.size].reshape(seen.shape)
        two, one = self.seen.sum(2), self.seen.sum(1)
        right2 = (_ALL * 31 >> 5) * (4 * two[:, :, 2] + 2) // (4 * two.sum(2) + 9)
        right1 = (_ALL * 31 >> 5) * (4 * one[:, :, 1] + 2) // (4 * one[:, :, :2].sum(2) + 9)
        right2[:, 0] = right1[:, 0] = 0
        part1 = (_ALL - right2)[:, :, None] * right1[:, None, :] >> _BITS
        both = np.minimum(part1 + right2[:, :, None], _ALL - _LEAST)
        self.shares = (both << _BITS | right2[:, :, None]).astype(np.uint32).ravel()
        used = self.used.copy()
        used[:, 0] -= self.seen[:, :, :, 1:].sum((1, 2, 3))   # the others are logged as class 0
        size = 1 + used * ((1 << _FINE) - self.c) // np.maximum(used.sum(1, keepdims=True), 1)
        size[np.arange(self.n), size.argmax(1)] += (1 << _FINE) - size.sum(1)
        below = np.cumsum(size, axis=1)
        self.ends = (below - size << 16 | below).astype(np.int32).ravel()
        self.class_at = np.repeat(np.tile(np.arange(self.c).astype(np.uint8), self.n), size.ravel())
        self.next = self.t + min(max(self.t, 8), _PERIOD)
        self.logged = 0

    def predict(self, k: int) -> None:
        """Parts of order 2 and of both orders for the first ``k`` lanes."""
        if self.t >= self.next:
            self._renew()
        hashed = self.before[0][:k] * np.uint32(2654435761)
        self.at = [(h >> _HASH).view(np.int32) + self.contexts[:k] for h in (hashed, hashed + self.before[1][:k] * np.uint32(2246822519))]
        (one, two) = (last.take(at) for last, at in zip(self.last, self.at, strict=True))
        self.guess, self.known = [one >> 2, two >> 2], [one & 3, two & 3]
        self.state = (self.known[1] << 2) + self.known[0] * (self.guess[0] != self.guess[1]) + self.states[:k]
        shares = self.shares.take(self.state)
        self.two, self.base = (shares & np.uint32(_ALL - 1)).view(np.int32), (shares >> np.uint32(_BITS)).view(np.int32)
        self.rest = np.int32(_ALL) - self.base

    def _parts(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and size of the part of each rank's class, or of the rank itself if a context
        gives it, and the bits that follow."""
        ends = self.ends.take(c + self.rows[:len(c)])
        begin = self.rest * (ends >> 16) >> _FINE
        size = (self.rest * (ends & 0xFFFF) >> _FINE) - begin
        begin += self.base
        for by, start, end in ((self.by[0], self.two, self.base), (self.by[1], np.int32(0), self.two)):
            np.putmask(begin, by, start)
            np.putmask(size, by, end - start)
        return begin.astype(_U), size.astype(_U), (c >> 2).astype(_U)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Begin and size of each rank's part, the bits that follow and what they hold."""
        by_two = (x == self.guess[1]) & (self.two > 0)
        by_one = (x == self.guess[0]) & (self.base > self.two) & ~by_two
        self.by = by_one, by_two
        free = ~(by_one | by_two)
        c = self.of.take(x) * free
        inside = (x & (np.int32(1) << (c >> 2)) - np.int32(1)).astype(_U)
        parts = self._parts(c)
        self._learn(x, c)
        return *parts, inside

    def find(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and size of the part that holds each place, the bits that follow."""
        free, by_two = place >= self.base, place < self.two
        self.by = ~(free | by_two), by_two
        fine = (((place - self.base + np.int32(1)) << _FINE) - np.int32(1)) // self.rest
        self.found = self.class_at.take(fine + self.finely[:len(place)], mode="clip") * free.view(np.uint8).astype(np.int32)
        return self._parts(self.found)

    def ranks(self, inside: np.ndarray) -> np.ndarray:
        """The ranks found, by what follows."""
        c = self.found
        x = np.minimum((np.int32(4) + (c & 3) << (c >> 2)) + inside.astype(np.int32), self.top)
        for by, guess in zip(self.by, self.guess, strict=True):
            np.putmask(x, by, guess)
        self._learn(x, c)
        return x

    def _learn(self, x: np.ndarray, c: np.ndarray) -> None:
        k, (states, kinds), (by_one, by_two) = len(x), self.log[:, self.logged], self.by
        states[:k] = self.state * 3 + (by_one.view(np.int8) + 2 * by_two.view(np.int8))
        np.add(c, self.rows[:k], out=kinds[:k])
        states[k:], kinds[k:] = self.seen.size, self.used.size
        fresh = (x << 2) + np.int32(1)
        for o in (0, 1):
            self.last[o][self.at[o]] = fresh + (self.guess[o] == x) * np.minimum(self.known[o], 2)
        self.before[1][:k] = self.before[0][:k]
        self.before[0][:k] = x.view(np.uint32)
        self.t += 1
        self.logged += 1


def _lengths(length: int) -> list[int]:
    """How many ids of a block each stream holds."""
    each = -(-length // STREAMS)
    return [max(0, min(each, length - i * each)) for i in range(STREAMS)]


def encode(ids: np.ndarray, vocabulary: int) -> bytes:
    """A segment: header, its ids by frequency, then for every block its header and units."""
    count = np.bincount(ids, minlength=vocabulary)
    listed = np.argsort(-count, kind="stable")[:np.count_nonzero(count)]
    if len(listed) > _MOST_IDS:
        raise ValueError(f"more than {_MOST_IDS} different ids")
    table = listed.astype("<u2" if vocabulary <= 1 << 16 else "<u4").tobytes()
    n_blocks = -(-len(ids) // BLOCK)
    out = [_HEAD.pack(_MAGIC, _VERSION, 0, vocabulary, n_blocks, len(listed), zlib.crc32(table)), table]
    rank = np.zeros(vocabulary, np.int32)
    rank[listed] = 4 + np.arange(len(listed))
    for first in range(0, n_blocks, LANES):
        some = ids[first * BLOCK:(first + LANES) * BLOCK]
        out += _encode_lanes(some.astype("<u4"), rank.take(some), len(listed))
    return b"".join(out)


def _put(units: np.ndarray, used: np.ndarray, i: np.ndarray, low: np.ndarray) -> None:
    """Put out the leading 32 bits of lanes ``i``; their carries go back."""
    at = used[i]
    units[at, i] = (low >> _U(31)).astype(np.uint32)
    used[i] = at + 1
    over = low > _FULL
    i, at = i[over], at[over] - 1
    while len(i):
        units[at, i] += np.uint32(1)
        over = units[at, i] == 0
        i, at = i[over], at[over] - 1


def _encode_lanes(ids: np.ndarray, ranks: np.ndarray, n_ids: int) -> list[bytes]:
    n = -(-len(ids) // BLOCK)
    size = [min(BLOCK, len(ids) - b * BLOCK) for b in range(n)]
    length = np.array([_lengths(s) for s in size]).ravel()    # never grows from lane to lane
    steps = int(length[0])
    by_step = np.zeros((steps, n * STREAMS), np.int32)
    whole = len(ids) // BLOCK
    by_step[:, :whole * STREAMS] = ranks[:whole * BLOCK].reshape(whole * STREAMS, BLOCK // STREAMS).T[:steps]
    at = whole * BLOCK
    for lane in range(whole * STREAMS, n * STREAMS):
        by_step[:length[lane], lane] = ranks[at:at + length[lane]]
        at += length[lane]
    model = _Model(n, n_ids)
    low, span = np.zeros(len(length), _U), np.full(len(length), _FULL)
    units, used = np.zeros((steps + 1, len(length)), np.uint32), np.zeros(len(length), np.int64)
    active = len(length)
    for t in range(steps):
        while length[active - 1] <= t:
            active -= 1
        lo, sp = low[:active], span[:active]
        model.predict(active)
        begin, part, bits, inside = model.place(by_step[t, :active])
        sp >>= _U(_BITS)
        lo += sp * begin
        sp *= part
        sp >>= bits
        lo += sp * inside
        i = np.flatnonzero(sp <= _LOW)
        if len(i):
            l = lo[i]
            _put(units, used, i, l)
            lo[i] = (l & _LOW) << _U(32)
            sp[i] <<= _U(32)
    i = np.flatnonzero(length)
    _put(units, used, i, low[i] + _LOW)    # a value in every span, zeros behind it
    units = np.ascontiguousarray(units.T)
    out = []
    for b in range(n):
        crc = zlib.crc32(ids[b * BLOCK:(b + 1) * BLOCK])
        lanes = range(b * STREAMS, (b + 1) * STREAMS)
        out += [_BLOCK_HEAD.pack(size[b], crc, *(int(used[i]) for i in lanes)),
                *(units[i, :used[i]].astype("<u4").tobytes() for i in lanes)]
    return out


def decode(segment: bytes) -> np.ndarray:
    """The ids of a segment; raises ValueError if a checksum differs."""
    magic, version, _, vocabulary, n_blocks, n_ids, crc = _HEAD.unpack_from(segment)
    if magic != _MAGIC or version != _VERSION:
        raise ValueError("not a token segment")
    kind = np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")
    at, out, blocks = _HEAD.size + kind.itemsize * n_ids, [], []
    if zlib.crc32(segment[_HEAD.size:at]) != crc:
        raise ValueError("checksum of the list of ids differs")
    listed = np.frombuffer(segment, kind, n_ids, _HEAD.size).astype("<u4")
    for i in range(n_blocks):
        length, crc, *used = _BLOCK_HEAD.unpack_from(segment, at)
        at += _BLOCK_HEAD.size
        streams = []
        for u in used:
            streams.append(np.frombuffer(segment, "<u4", u, at))
            at += 4 * u
        blocks.append((length, crc, streams))
        if len(blocks) == LANES or i == n_blocks - 1:
            out.append(_decode_lanes(blocks, listed))
            blocks = []
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def _decode_lanes(blocks: list, listed: np.ndarray) -> np.ndarray:
    streams = [s for b in blocks for s in b[2]]
    length = np.array([_lengths(b[0]) for b in blocks]).ravel()
    steps = int(length[0])
    width = max(steps, *(len(s) for s in streams)) + 3
    units = np.zeros((len(streams), width), _U)
    for i, s in enumerate(streams):
        units[i, :len(s)] = s
    code = units[:, 0] >> _U(1) << _U(32)
    units[:, :-1] = (units[:, :-1] & _U(1)) << _U(31) | units[:, 1:] >> _U(1)    # the window ends one bit before a unit
    code |= units[:, 0]
    units = units.astype(np.uint32).ravel()
    at = np.arange(len(streams)) * width + 1
    model = _Model(len(blocks), len(listed))
    span = np.full(len(streams), _FULL)
    by_step = np.zeros((steps, len(streams)), np.int32)
    active = len(length)
    for t in range(steps):
        while length[active - 1] <= t:
            active -= 1
        sp, co = span[:active], code[:active]
        model.predict(active)
        sp >>= _U(_BITS)
        begin, part, bits = model.find(np.minimum(co // sp, _U(_ALL - 1)).astype(np.int32))
        co -= sp * begin
        sp *= part
        sp >>= bits
        inside = co // sp
        co -= sp * inside
        by_step[t, :active] = model.ranks(inside)
        i = np.flatnonzero(sp <= _LOW)
        if len(i):
            j = at[i]
            co[i] = co[i] << _U(32) | units.take(j, mode="clip")
            sp[i] <<= _U(32)
            at[i] = j + 1
    out = []
    whole = sum(b[0] == BLOCK for b in blocks)
    ids = listed.take(by_step.T - 4, mode="clip")
    rows = [ids[:whole * STREAMS].reshape(whole, -1)] if whole else []
    for b, (size, crc, _) in enumerate(blocks):
        if b < whole:
            got = rows[0][b]
        else:
            got = np.concatenate([ids[i, :length[i]] for i in range(b * STREAMS, (b + 1) * STREAMS)])
        if zlib.crc32(np.ascontiguousarray(got)) != crc:
            raise ValueError(f"checksum of block {b} differs")
        out.append(got)
    return np.concatenate(out)
