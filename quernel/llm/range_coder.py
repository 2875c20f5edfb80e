"""Range coder for token ids that mixes the predictions of order 0, 1 and 2.

A block of ids is coded by itself. Its model starts empty and learns as it goes. Ids
are numbered in the order in which they first come; contexts are compared in full.

* order 2 and order 1: for the last two ids, or the last one, the two ids that
  followed most, with counts; the count of one that did not follow decays;
* order 0: the share of each id in the block so far, counted anew every few hundred
  ids, where an id that is new since then counts once;
* new: any of 65,536 ids.

The probability of an id is the weighted sum of what all orders give it. The weights
depend on how sure orders 1 and 2 are and whether they agree; after each id every
order's weight grows by its part in that id's probability.

The interval holds first the candidates of orders 2 and 1, each with its whole
sum, then all other ids of order 0, without the candidates, then the new ones. So
no id has two places, and neither side needs a search. Blocks have a length and a CRC-32.

Blocks advance in step, one id of every block at a time, as numpy arrays.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 4096
_LEAST_IDS, _FULL_LANES = 2048, 256
MAGIC = b"CMX2"
_HEAD = struct.Struct("<4sIII")
_SLOTS2 = 1 << 13
_CONTEXTS = 32
_RECOUNT = 512
#: First weights of order 2, order 1, order 0 and new, and the sum at which weights are halved.
_WEIGHTS, _LIMIT, _GAIN = (8, 6, 8, 8), 1 << 11, 32
_ANY, _REST, _NEW = 1 << 16, 4, 5
_U64 = np.uint64
_TOP, _BOTTOM, _WORD = _U64(1 << 48), _U64(1 << 32), _U64(16)
_LOW_MASK = _U64((1 << 32) - 1)

# A context is one integer: two followers, their counts, and for order 2 the context itself.
_ID_BITS, _COUNT_BITS, _SCALE = 14, 5, 12
_ID, _MOST = (1 << _ID_BITS) - 1, (1 << _COUNT_BITS) - 1
_COUNTS_AT, _KEY_AT = 2 * _ID_BITS, 2 * _ID_BITS + 2 * _COUNT_BITS
_BODY, _KEY = (1 << _KEY_AT) - 1, (1 << 26) - 1

# For each pair of counts: how sure it is (no follower, two, one seen once, one seen more), and both shares.
_A, _B = np.arange(1 << 2 * _COUNT_BITS) & _MOST, np.arange(1 << 2 * _COUNT_BITS) >> _COUNT_BITS
_SURE = np.where(_A == 0, 0, np.where(_B > 0, 1, np.where(_A <= 2, 2, 3)))
_SECOND = (_B << _SCALE) // np.maximum(_A + _B, 1)
_FIRST = np.where(_A == 0, 0, (1 << _SCALE) - _SECOND)


class _Model:
    """What all blocks know so far; the same in coding and decoding.

    Numbers of ids begin with 1; 0 is no id. Arrays are by part, then by block.
    """

    def __init__(self, lanes: int, length: int, by_id: bool = True):
        """``by_id`` keeps the number of every id, which neither ``encode`` nor ``decode`` needs: it is the largest table."""
        self.lane, self.length = np.arange(lanes), length
        self.by_id, self.by_step = self.lane * _ANY, self.lane * length
        self.by_number = self.lane * (length + 1)
        self.number = np.zeros(lanes * _ANY, np.int16) if by_id else None
        self.ids = np.zeros(lanes * (length + 1), np.uint16)
        self.known = np.zeros(lanes, np.int64)
        self.count = np.zeros(lanes * (length + 1), np.int16)
        # Order 0: first place and length of each number's run in the table, as one integer; none is behind all.
        self.run_of = np.full(lanes * (length + 1), _ID << _ID_BITS, np.int32)
        self.table = np.zeros(lanes * length, np.int16)
        self.places = np.zeros(lanes, np.int64)
        self.after1 = np.zeros(lanes * (length + 1), np.int64)
        self.after2 = np.full(lanes * _SLOTS2, -1, np.int64)
        self.weights = np.tile(np.array(_WEIGHTS, np.int64)[:, None], lanes * _CONTEXTS)
        self.slots, self.contexts = self.lane * _SLOTS2, self.lane * _CONTEXTS
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)

    def predict(self):
        """The parts of the interval: four candidates, other known ids, new ids."""
        self.at1 = self.by_number + self.last
        self.key2 = self.last << 13 | self.before
        self.at2 = self.slots + (((self.last * 40503 + self.before * 60493) >> 3) & (_SLOTS2 - 1))
        state = np.empty((2, len(self.lane)), np.int64)
        found = self.after2.take(self.at2)
        state[0] = np.where((found >> _KEY_AT) & _KEY == self.key2, found & _BODY, 0)
        state[1] = self.after1.take(self.at1)
        self.most, self.second = state & _ID, (state >> _ID_BITS) & _ID
        self.counts = state >> _COUNTS_AT
        sure = _SURE.take(self.counts)
        context = sure[0] * 8 + sure[1] * 2 + (self.most[0] == self.most[1])
        self.row = self.contexts + context
        self.weight = weight = self.weights.take(self.row, axis=1)
        # Orders 2 and 1: the weight of each, shared out by counts.
        self.part = part = np.empty((4, len(self.lane)), np.int64)
        self.guess = guess = np.empty((4, len(self.lane)), np.int64)
        part[::2], part[1::2] = weight[:2] * _FIRST.take(self.counts), weight[:2] * _SECOND.take(self.counts)
        guess[::2], guess[1::2] = self.most, self.second
        mass = np.empty((6, len(self.lane)), np.int64)
        mass[:4] = part
        same = guess[:2, None] == guess[None, 2:]
        mass[:2] += (same * part[2:]).sum(axis=1)
        once = ~same.any(axis=0)
        mass[2:4] *= once
        self.candidate = guess.copy()
        self.candidate[2:] *= once
        # Order 0's share of each candidate; floats, since they round alike everywhere.
        self.run_at = self.run_of.take(self.by_number + self.candidate)
        size = self.run_at & _ID
        whole = (weight[2] << _SCALE) * (self.places > 0)
        self.unit0 = whole / np.maximum(self.places, 1)
        shared = (self.unit0 * size).astype(np.int64)
        mass[:4] += shared
        mass[4] = whole - shared.sum(axis=0)
        mass[5] = weight[3] << _SCALE
        self.mass, self.upto = mass, mass.copy()
        # Row by row: a sum along the short axis is slower.
        for before, row in zip(self.upto, self.upto[1:]):
            row += before
        self.total = self.upto[5]
        self.others = self.places - size.sum(axis=0)

    def outer(self, slot):
        at = slot * len(self.lane) + self.lane
        size = self.mass.ravel().take(at)
        return self.upto.ravel().take(at) - size, size

    def run(self, lanes, number):
        """(start, size) of known numbers in order 0 without the candidates."""
        run = self.run_of.take(self.by_number[lanes] + number).astype(np.int64)
        others = self.run_at[:, lanes]
        first = run >> _ID_BITS
        skipped = ((others & _ID) * (others >> _ID_BITS < first)).sum(axis=0)
        return first - skipped, run & _ID

    def at_place(self, lanes, place):
        """The numbers at these places of order 0 without the candidates."""
        for run in np.sort(self.run_at[:, lanes], axis=0):
            place = place + (run & _ID) * (place >= run >> _ID_BITS)
        # A damaged block may point behind the table; its checksum tells.
        return self.table.take(self.by_step[lanes] + np.minimum(place, self.length - 1)).astype(np.int64)

    def learn(self, ids, number, slot):
        """``number`` is 0 for new ids."""
        mine = (self.guess == number) * self.part
        given = np.empty((4, len(self.lane)))
        given[:2] = mine[::2] + mine[1::2]
        given[2] = self.unit0 * (self.run_of.take(self.by_number + number) & _ID)
        given[3] = np.where(slot == _NEW, self.mass[5], 0)
        weight = self.weight + (given * (_GAIN / np.maximum(given.sum(axis=0), 1))).astype(np.int64)
        weight = np.where(weight.sum(axis=0) > _LIMIT, (weight + 1) >> 1, weight)
        for all_rows, mine_now in zip(self.weights, weight):
            all_rows[self.row] = mine_now
        new = (slot == _NEW).nonzero()[0]
        if len(new):
            self.known[new] += 1
            number = number.copy()
            number[new] = self.known[new]
            at = self.by_number[new] + number[new]
            if self.number is not None:
                self.number[self.by_id[new] + ids[new]] = number[new]
            self.ids[at] = ids[new]
            self.run_of[at] = self.places[new] << _ID_BITS | 1
            self.table[self.by_step[new] + self.places[new]] = number[new]
            self.places[new] += 1
        self.count[self.by_number + number] += 1
        # The count of the follower grows, the other's decays; the more frequent, or the later of equals, is first.
        first, second = self.counts & _MOST, self.counts >> _COUNT_BITS
        is_first = self.most == number
        count = np.where(is_first, first, np.where(self.second == number, second, 0)) + 2
        count = np.minimum(count, _MOST)
        other, left = np.where(is_first, self.second, self.most), np.where(is_first, second, first)
        left -= left >> 2
        mine, theirs = number | count << _COUNTS_AT, other | left << _COUNTS_AT
        ahead = count >= left
        front, back = np.where(ahead, mine, theirs), np.where(ahead, theirs, mine)
        state = front | (back & _ID) << _ID_BITS | (back >> _COUNTS_AT) << (_COUNTS_AT + _COUNT_BITS)
        self.after1[self.at1] = state[1]
        self.after2[self.at2] = state[0] | self.key2 << _KEY_AT
        self.before, self.last = self.last, number

    def count_anew(self, so_far: int):
        """Order 0 from the counts: every number's run is as long as it came often."""
        lanes = len(self.lane)
        used = int(self.known.max()) + 1
        count = self.count.reshape(lanes, -1)[:, :used]
        first = np.where(count > 0, np.cumsum(count, axis=1) - count, _ID)
        self.run_of.reshape(lanes, -1)[:, :used] = first << _ID_BITS | count
        numbers = np.tile(np.arange(used, dtype=np.int16), lanes)
        self.table.reshape(lanes, -1)[:, :so_far] = np.repeat(numbers, count.ravel()).reshape(-1, so_far)
        self.places[:] = so_far


def block_ids(n: int) -> int:
    """Ids of a block for a string of ``n``: shorter in short strings, so that a step still serves many blocks."""
    return min(BLOCK_IDS, max(_LEAST_IDS, -(-n // _FULL_LANES)))


def _recounts(length: int) -> set[int]:
    """Steps at which order 0 is counted anew."""
    return {64, 128, 256, *range(_RECOUNT, length, _RECOUNT)}


def _settled(low, span):
    """Lanes whose first word is settled, or is forced where the range got small; and the range then."""
    settled = (low ^ (low + span)) < _TOP
    small = (span < _BOTTOM) & ~settled
    if np.count_nonzero(small):
        span = np.where(small, (~low + _U64(1)) & _LOW_MASK, span)
        settled |= small
    return settled, span


def _shift(low, span, emit):
    """Move out words that are settled, or force them where the range got small."""
    settled, span = _settled(low, span)
    moving = settled.nonzero()[0]
    # Only where a word was moved out may there be another.
    while len(moving):
        first, width = low[moving], span[moving]
        emit(moving, first)
        first <<= _WORD
        settled, width = _settled(first, width << _WORD)
        low[moving], span[moving] = first, width
        moving = moving[settled]
    return low, span


def _narrow(low, span, start, size, total):
    unit = span // total.astype(_U64)
    return low + unit * start.astype(_U64), unit * size.astype(_U64)


def _numbers(grid: np.ndarray) -> np.ndarray:
    """For each id of each block its number, by step; negative where the id is new."""
    lanes, length = grid.shape
    out = np.empty((length, lanes), np.int16)
    for at in range(0, lanes, 64):
        block = grid[at : at + 64]
        order = np.argsort(block, axis=1, kind="stable")
        ranked = np.take_along_axis(block, order, axis=1)
        begins = np.ones(block.shape, bool)
        begins[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
        # Equal ids are in a row, the first that comes before the others.
        begin = np.maximum.accumulate(np.where(begins, np.arange(length), 0), axis=1)
        first = np.take_along_axis(order, begin, axis=1)
        new = np.zeros(block.shape, bool)
        np.put_along_axis(new, order, begins, axis=1)
        number = np.empty(block.shape, np.int16)
        np.put_along_axis(number, order, np.take_along_axis(np.cumsum(new, axis=1, dtype=np.int16), first, axis=1), axis=1)
        out[:, at : at + 64] = np.where(new, -number, number).T
    return out


def encode(ids: np.ndarray, length: int | None = None) -> bytes:
    """Ids below 65,536 as a string of independent blocks of at most 8,191 ids."""
    n = len(ids)
    if not n:
        return _HEAD.pack(MAGIC, 0, 0, 0)
    length = min(length or block_ids(n), n)
    lanes = -(-n // length)
    if length >= 1 << 13:
        raise ValueError("a block has at most 8,191 ids")
    grid = np.zeros(lanes * length, np.uint16)
    grid[:n] = ids
    grid = grid.reshape(lanes, length)
    counts = np.full(lanes, length, np.uint32)
    counts[-1] = n - (lanes - 1) * length
    checks = [zlib.crc32(grid[i, : counts[i]].astype("<u4").tobytes()) for i in range(lanes)]
    steps, numbers = np.ascontiguousarray(grid.T), _numbers(grid)
    del grid
    model = _Model(lanes, length, by_id=False)
    low, span = np.zeros(lanes, _U64), np.full(lanes, 2**64 - 1, _U64)
    words = np.zeros((lanes, length * 3 + 16), np.uint16)
    filled = np.zeros(lanes, np.int64)

    def emit(moving, low):
        at = filled[moving]
        words[moving, at] = low >> _U64(48)
        filled[moving] = at + 1

    recounts = _recounts(length)
    for t in range(length):
        if t in recounts:
            model.count_anew(t)
        now = steps[t].astype(np.int64)
        model.predict()
        number = np.maximum(numbers[t], 0).astype(np.int64)
        known = number > 0
        slot = np.where(known, _REST, _NEW)
        # No known id is a candidate twice.
        for i, hit in enumerate((model.candidate == number) & known):
            slot -= (_REST - i) * hit
        low, span = _narrow(low, span, *model.outer(slot), model.total)
        deep = (slot >= _REST).nonzero()[0]
        if len(deep):
            start, size = model.run(deep, number[deep])
            new = slot[deep] == _NEW
            start, size = np.where(new, now[deep], start), np.where(new, 1, size)
            total = np.where(new, _ANY, model.others[deep])
            low[deep], span[deep] = _narrow(low[deep], span[deep], start, size, total)
        low, span = _shift(low, span, emit)
        model.learn(now, number, slot)
    for _ in range(4):
        emit(np.arange(lanes), low)
        low = low << _WORD
    head = _HEAD.pack(MAGIC, lanes, length, zlib.crc32(counts.tobytes()))
    index = np.stack([counts, filled.astype(np.uint32), np.array(checks, np.uint32)]).astype("<u4").tobytes()
    return head + index + b"".join(words[i, : filled[i]].astype("<u2").tobytes() for i in range(lanes))


def decode(data: bytes) -> np.ndarray:
    """The ids of ``encode``. A block that fails its checksum is an error."""
    magic, lanes, length, _ = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token file")
    if not lanes:
        return np.zeros(0, np.uint16)
    index = np.frombuffer(data, "<u4", lanes * 3, _HEAD.size).reshape(3, lanes)
    counts, sizes, checks = index
    body = np.frombuffer(data, "<u2", int(sizes.sum()), _HEAD.size + index.nbytes)
    body = np.r_[body, np.zeros(8, np.uint16)]
    at = np.r_[0, np.cumsum(sizes.astype(np.int64))[:-1]]
    code = np.zeros(lanes, _U64)
    for _ in range(4):
        code = code << _WORD | body[at].astype(_U64)
        at = at + 1
    model = _Model(lanes, length, by_id=False)
    low, span = np.zeros(lanes, _U64), np.full(lanes, 2**64 - 1, _U64)
    out = np.zeros((length, lanes), np.uint16)

    def take(moving, _low):
        # A damaged block may ask for more than there is; its checksum tells.
        code[moving] = code[moving] << _WORD | body[np.minimum(at[moving], len(body) - 1)].astype(_U64)
        at[moving] += 1

    def value(lanes, total):
        total = total.astype(_U64)
        return np.minimum((code[lanes] - low[lanes]) // (span[lanes] // total), total - _U64(1)).astype(np.int64)

    recounts = _recounts(length)
    for t in range(length):
        if t in recounts:
            model.count_anew(t)
        model.predict()
        slot = (value(model.lane, model.total) >= model.upto[:5]).sum(axis=0)
        low, span = _narrow(low, span, *model.outer(slot), model.total)
        number = np.where(slot < _REST, model.candidate[np.minimum(slot, 3), model.lane], 0)
        deep = (slot >= _REST).nonzero()[0]
        now = np.zeros(lanes, np.int64)
        if len(deep):
            new = slot[deep] == _NEW
            total = np.where(new, _ANY, np.maximum(model.others[deep], 1))
            place = value(deep, total)
            start, size = place.copy(), np.ones(len(deep), np.int64)
            known = (~new).nonzero()[0]
            number[deep[known]] = model.at_place(deep[known], place[known])
            start[known], size[known] = model.run(deep[known], number[deep[known]])
            now[deep] = place
            low[deep], span[deep] = _narrow(low[deep], span[deep], start, size, total)
        now = np.where(slot == _NEW, now, model.ids.take(model.by_number + number))
        low, span = _shift(low, span, take)
        out[t] = now
        model.learn(now, number, slot)
    out = np.ascontiguousarray(out.T)
    for i in range(lanes):
        if zlib.crc32(out[i, : counts[i]].astype("<u4").tobytes()) != checks[i]:
            raise ValueError(f"block {i} is damaged")
    return out.ravel()[: int(counts.sum())]
