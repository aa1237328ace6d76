"""Adaptive context-mixing range coder for token ids, many streams side by side.

A block is coded with a model that starts fresh in it. Three experts predict the next id:

* order 2: the id that last followed the same two ids (hashed context);
* order 1: the id that last followed the same id;
* order 0: the id frequencies so far.

The mixture P(id) = w2 [id = guess2] + w1 [id = guess1] + w0 P0(id) drives a 64-bit range
coder with carries. The weights are adaptive, one set for each pair of confidences that the
two guesses have earned (and whether they agree). Guesses adapt with every id, weights and
frequencies after the steps that ``_refreshes`` names. Blocks hold at most 32,767 different
ids (``encode_blocks`` refuses others).

A block is cut into up to ``STREAMS`` equal runs of ids. Each run has a range coder of its
own; all of them share, and teach, the model of the block. Encoder and decoder run the
streams of some hundred blocks in step, one numpy lane per stream, so neither works id by id
in Python, and the models in use stay small enough for a processor's cache.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMR2"
STREAMS = 16
MOST_IDS = 32_767
#: Ids of a stream at least, and streams that are coded side by side.
_STREAM_IDS, _SIDE = 128, 4096
_BITS1, _BITS2, _CASES = 11, 12, 128
_GAIN = 24
_0, _16, _32, _48 = (np.uint64(k) for k in (0, 16, 32, 48))
_LOW, _WORD = np.uint64(1 << 32), np.uint64(0xFFFFFFFF)
#: Ids below this get their places in a block from a table instead of a sort.
_SMALL_ID = 1 << 17


class Corrupt(ValueError):
    """A block whose checksum or structure is wrong."""


def _streams(n: int) -> tuple[int, int]:
    """Number of streams of a block of ``n`` ids, and ids of each (the last may have fewer)."""
    each = -(-n // min(STREAMS, max(1, n // _STREAM_IDS)))
    return -(-n // each), each


def _refreshes(step: int) -> bool:
    return step in (8, 32) or (step > 0 and step % 64 == 0)


class _Lanes:
    """The streams of some blocks, longest first: block, first id and number of ids of each."""

    def __init__(self, lens: list[int]):
        block, first, size = [], [], []
        for k, n in enumerate(lens):
            count, each = _streams(n)
            block += [k] * count
            first += range(0, n, each)
            size += [each] * (count - 1) + [n - each * (count - 1)]
        size = np.array(size, np.int64)
        order = np.argsort(-size, kind="stable")
        self.block, self.first, self.size = np.array(block)[order], np.array(first)[order], size[order]
        self.steps = int(self.size[0])
        #: For each step, the lanes that have more ids.
        self.live = np.searchsorted(-self.size, -np.arange(self.steps), "left").tolist()


class _Model:
    """State of all blocks; the same calls in the same order on both sides."""

    def __init__(self, sizes: np.ndarray, lane_block: np.ndarray):
        blocks = len(sizes)
        self.sizes, self.base = sizes, np.concatenate([[0], np.cumsum(sizes)])[:-1]
        # order-0 frequencies of a block sum up to ``1 << bits``
        self.bits = np.where(sizes > 4096, 16, 13)
        self.lift = (16 - self.bits).repeat(sizes).astype(np.uint64)
        self.count = np.ones(int(sizes.sum()), np.int64)
        self.off1, self.off2, self.offw = lane_block << _BITS1, lane_block << _BITS2, lane_block * _CASES
        # guess << 3 | times it was right in a row (7 at most); guess -1: none yet
        self.slot1 = np.full(blocks << _BITS1, -8, np.int32)
        self.slot2 = np.full(blocks << _BITS2, -8, np.int32)
        # for each case: how often it came, order 2 was right, order 1 was right where order 2 wasn't
        trust = np.arange(16, 240, 28) / 256
        self.came = np.full(blocks * _CASES, 8.0)
        self.right2 = np.tile(np.repeat(trust, 8), blocks * 2) * 8
        self.right1 = np.tile(np.tile(trust, 8), blocks * 2) * (8 - self.right2)
        self.seen: list[tuple] = []
        self.refresh()

    def refresh(self) -> None:
        """Take in what came since the last time: weights of the orders, and order-0 frequencies."""
        if self.seen:
            cases, twos, ones, places = (np.concatenate(c) for c in zip(*self.seen))
            self.seen.clear()
            n = len(self.came)
            self.came += np.bincount(cases, minlength=n)
            self.right2 += np.bincount(cases[twos], minlength=n)
            self.right1 += np.bincount(cases[ones & ~twos], minlength=n)
            self.count += _GAIN * np.bincount(places, minlength=len(self.count))
        w2 = (self.right2 / (self.came + 0.5) * 65000).astype(np.int64) + 100
        w1 = ((65536 - w2) * (self.right1 / (self.came - self.right2 + 0.5) * 0.98)).astype(np.int64) + 4
        # where the part of order 1 starts, and that of order 0, of 1 << 32
        self.weights = w2.astype(np.uint64) << _16 | (w2 + w1).astype(np.uint64) << _48
        total = np.add.reduceat(self.count, self.base)
        share = ((1 << self.bits) - self.sizes) / total
        freq = (self.count * share.repeat(self.sizes)).astype(np.int64) + 1
        freq[self.base] += (1 << self.bits) - np.add.reduceat(freq, self.base)
        cum = np.cumsum(freq) - freq                        # ascending over all blocks
        self.freq = freq
        own = (cum - cum[self.base].repeat(self.sizes)).astype(np.uint64)
        self.part = (own << _32 | freq.astype(np.uint64)) << self.lift

    def predict(self, n: int, i1: np.ndarray, i2: np.ndarray):
        """For the first ``n`` lanes, with their contexts: what the slots hold, the weights' case,
        and where the parts of orders 1 and 0 start."""
        v1, v2 = self.slot1.take(i1), self.slot2.take(i2)
        case = ((v1 ^ v2).view(np.uint32) < 8) * np.int32(64)    # both guess the same
        case += (v2 & 7) << 3
        case += v1 & 7
        case = case + self.offw[:n]
        w = self.weights.take(case)
        return v1, v2, case, w & _WORD, w >> _32

    def learn(self, i1, i2, v1, v2, x8, hit2, hit1, case, q) -> None:
        # streams of a block may meet in a slot: the last one's entry stays
        self.slot1[i1] = np.where(hit1, np.minimum(v1 + 1, v1 | 7), x8)
        self.slot2[i2] = np.where(hit2, np.minimum(v2 + 1, v2 | 7), x8)
        self.seen.append((case, hit2, hit1, q))

    def finder(self) -> np.ndarray:
        """The id at each place of the order-0 part, block after block."""
        return (np.arange(len(self.freq)) - self.base.repeat(self.sizes)).astype(np.int16).repeat(self.freq)


def _carry(words: np.ndarray, places: np.ndarray) -> None:
    """Add one to the words at the places, and to those before them while it runs over."""
    while len(places):
        words[places] += np.uint32(1)
        places = places[words[places] == 0] - 1


def _encode_group(symbols: list[np.ndarray], sizes: np.ndarray) -> list[bytes]:
    """Number of code words of each stream, and the words, of each block."""
    lanes = _Lanes([len(s) for s in symbols])
    steps, many = lanes.steps, len(lanes.block)
    rows = np.zeros((many, steps + 2), np.int32)               # two zeros stand before each stream
    for row, k, lo, n in zip(rows, lanes.block.tolist(), lanes.first.tolist(), lanes.size.tolist()):
        row[2:n + 2] = symbols[k][lo:lo + n]
    grid = np.ascontiguousarray(rows.T)
    width = steps + 4
    words = np.zeros(many * width, np.uint32)
    at = np.arange(many) * width                               # where the next word goes
    low, rng = np.zeros(many, np.uint64), np.full(many, 0xFFFFFFFFFFFFFFFF, np.uint64)
    model = _Model(sizes, lanes.block)
    base = model.base[lanes.block]
    for t, n in enumerate(lanes.live):
        if t and _refreshes(t):
            model.refresh()
        if t % 64 == 0:                                        # places and contexts of the next steps at once
            xs = grid[t + 2:t + 66]
            one, two = grid[t + 1:t + 1 + len(xs)], grid[t:t + len(xs)]
            qs, x8s = xs + base, xs << 3
            i1s, i2s = _context1(one) + model.off1, _context2(one, two) + model.off2
        k = t % 64
        x8, q, i1, i2 = x8s[k, :n], qs[k, :n], i1s[k, :n], i2s[k, :n]
        v1, v2, case, part1, part0 = model.predict(n, i1, i2)
        hit2, hit1 = (v2 ^ x8).view(np.uint32) < 8, (v1 ^ x8).view(np.uint32) < 8
        weight0 = (_LOW - part0) >> _16
        place = model.part.take(q)
        # where the part of the interval starts, and its size, of 1 << 32
        start = np.where(hit1, part1, part0 + weight0 * (place >> _32))
        size = np.where(hit1, part0 - part1, weight0 * (place & _WORD))
        start[hit2] = _0
        np.copyto(size, part1, where=hit2)
        unit = rng[:n] >> _32
        start *= unit
        now, new = unit * size, low[:n] + start
        _carry(words, at[:n][new < start] - 1)
        low[:n], rng[:n] = new, now
        small = np.flatnonzero(now < _LOW)
        if len(small):
            put, top = at[small], new[small]
            words[put] = top >> _32
            at[small] = put + 1
            low[small] = top << _32
            rng[small] = now[small] << _32
        model.learn(i1, i2, v1, v2, x8, hit2, hit1, case, q)
    # one more word, with zeros after it, names a value of the last interval
    last = low + _WORD
    _carry(words, at[last < low] - 1)
    words[at] = last >> _32
    rows, used = words.reshape(many, width), at + 1 - np.arange(many) * width
    streams: list[list[int]] = [[] for _ in symbols]
    for lane in np.lexsort((lanes.first, lanes.block)).tolist():
        streams[lanes.block[lane]].append(lane)
    return [used[own].astype(_length_type(len(s))).tobytes()
            + b"".join([rows[lane, :used[lane]].astype("<u4").tobytes() for lane in own])
            for own, s in zip(streams, symbols)]


def _length_type(n: int) -> str:
    """Of the number of words of a stream; an id takes one word at most."""
    return "<u2" if _streams(n)[1] < 65_000 else "<u4"


def _context1(p1: np.ndarray) -> np.ndarray:
    return p1 & ((1 << _BITS1) - 1)


def _context2(p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    return (p1 * np.int32(10007) + p2) & ((1 << _BITS2) - 1)


def _decode_group(coded: list[bytes], lens: list[int], sizes: np.ndarray) -> list[np.ndarray]:
    """Symbols of each block."""
    lanes = _Lanes(lens)
    steps, many = lanes.steps, len(lanes.block)
    streams = []
    for body, n in zip(coded, lens):
        count, kind = _streams(n)[0], np.dtype(_length_type(n))
        if len(body) < count * kind.itemsize:
            raise Corrupt("the streams of a block don't fill it")
        used = np.frombuffer(body, kind, count).astype(np.int64)
        words = body[count * kind.itemsize:]
        if 4 * int(used.sum()) != len(words):
            raise Corrupt("the streams of a block don't fill it")
        words, ends = np.frombuffer(words, "<u4"), np.cumsum(used).tolist()
        streams.append([words[lo:hi] for lo, hi in zip([0, *ends], ends)])
    width = max(len(w) for s in streams for w in s) + 4
    rows = np.zeros((many, width), np.uint32)
    for row, k, number in zip(rows, lanes.block.tolist(),
                              [lo // _streams(lens[k])[1] for k, lo in zip(lanes.block.tolist(), lanes.first.tolist())]):
        w = streams[k][number]
        row[:len(w)] = w
    words = rows.reshape(-1).astype(np.uint64)
    at = np.arange(many) * width
    code = (words[at] << _32) | words[at + 1]
    at += 2
    rng = np.full(many, 0xFFFFFFFFFFFFFFFF, np.uint64)
    out = np.zeros((steps, many), np.int32)
    model = _Model(sizes, lanes.block)
    base, shift = model.base[lanes.block], 16 - model.bits[lanes.block]
    places = (np.cumsum(1 << model.bits) - (1 << model.bits))[lanes.block]
    finder = model.finder()
    one = two = np.zeros(many, np.int32)
    for t, n in enumerate(lanes.live):
        if t and _refreshes(t):
            model.refresh()
            finder = model.finder()
        i1, i2 = _context1(one[:n]) + model.off1[:n], _context2(one[:n], two[:n]) + model.off2[:n]
        v1, v2, case, part1, part0 = model.predict(n, i1, i2)
        now = code[:n]
        unit = rng[:n] >> _32
        value = now // unit
        by2, by1 = value < part1, value < part0
        # order 0: the id at the value's place (exact: both are whole numbers far below 1 << 53)
        rest = (value - part0).view(np.int64).astype(np.float64) * 65536.0
        place = (rest / (_LOW - part0).view(np.int64).astype(np.float64)).astype(np.int64)
        place >>= shift[:n]
        place += places[:n]
        x = np.where(by1, v1 >> 3, finder.take(place, mode="clip"))
        np.copyto(x, v2 >> 3, where=by2)
        if x.min() < 0:
            raise Corrupt("a code word leads outside the block's ids")
        q = x + base[:n]
        weight0, place = (_LOW - part0) >> _16, model.part.take(q)
        start = np.where(by1, part1, part0 + weight0 * (place >> _32))
        size = np.where(by1, part0 - part1, weight0 * (place & _WORD))
        start[by2] = _0
        np.copyto(size, part1, where=by2)
        now = now - unit * start
        wide = unit * size
        code[:n], rng[:n] = now, wide
        small = np.flatnonzero(wide < _LOW)
        if len(small):
            get = at[small]
            code[small] = (now[small] << _32) | words.take(get, mode="clip")
            at[small] = get + 1
            rng[small] = wide[small] << _32
        out[t, :n] = x
        x8 = x << 3
        model.learn(i1, i2, v1, v2, x8, (v2 ^ x8).view(np.uint32) < 8, (v1 ^ x8).view(np.uint32) < 8, case, q)
        one, two = x, one
    blocks = [np.zeros(n, np.int32) for n in lens]
    for row, k, lo, n in zip(np.ascontiguousarray(out.T), lanes.block.tolist(), lanes.first.tolist(),
                             lanes.size.tolist()):
        blocks[k][lo:lo + n] = row[:n]
    return blocks


def _groups(lens: list[int]) -> list[list[int]]:
    """Blocks with ids, longest first, in groups of some ``_SIDE`` streams."""
    groups, room = [], 0
    for k in sorted((k for k, n in enumerate(lens) if n), key=lambda k: -lens[k]):
        if room <= 0:
            groups.append([])
            room = _SIDE
        groups[-1].append(k)
        room -= _streams(lens[k])[0]
    return groups


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids in ascending order, and the place of each id among them."""
    most = int(ids.max())
    if most >= _SMALL_ID:
        own, places = np.unique(ids, return_inverse=True)
        return own, places.astype(np.int32)
    met = np.zeros(most + 1, bool)
    met[ids] = True
    own = np.flatnonzero(met)
    number = np.empty(most + 1, np.int32)
    number[own] = np.arange(len(own))
    return own.astype(np.uint32), number.take(ids)


def _packed(own: np.ndarray) -> bytes:
    """Steps between ascending ids: a byte each; 255, and four more at the end, for the larger ones."""
    steps = np.diff(own, prepend=np.zeros(1, own.dtype))
    large = steps >= 255
    return np.where(large, 255, steps).astype(np.uint8).tobytes() + steps[large].astype("<u4").tobytes()


def _unpacked(known: bytes, n: int) -> np.ndarray:
    steps = np.frombuffer(known, np.uint8, n).astype(np.uint32)
    large = steps == 255
    if len(known) != n + 4 * np.count_nonzero(large):
        raise Corrupt("the ids of a block don't fill their table")
    steps[large] = np.frombuffer(known, "<u4", offset=n)
    return np.cumsum(steps, dtype=np.uint32)


def encode_blocks(blocks: list[np.ndarray], tables: list[bytes]) -> list[bytes]:
    """A self-contained payload for each block of ids; ``tables``: bytes to carry with each.

    Raises ``ValueError`` for a block of more than ``MOST_IDS`` different ids.
    """
    ids, coded = {}, {}
    for group in _groups([len(b) for b in blocks]):
        symbols = []
        for k in group:
            ids[k], own = _numbered(blocks[k])
            if len(ids[k]) > MOST_IDS:
                raise ValueError(f"a block of {len(ids[k])} different ids; {MOST_IDS} at most")
            symbols.append(own)
        coded.update(zip(group, _encode_group(symbols, np.array([len(ids[k]) for k in group]))))
    out: list[bytes] = []
    for k, block in enumerate(blocks):
        own = ids.get(k, np.zeros(0, np.uint32))
        known = _packed(own)
        table = zlib.compress(tables[k], 6)
        body = struct.pack("<4sIIII", MAGIC, len(block), len(own), len(known), len(table)) \
            + known + table + coded.get(k, b"")
        body += struct.pack("<I", zlib.crc32(block.astype("<u4").tobytes()))
        out.append(body + struct.pack("<I", zlib.crc32(body)))
    return out


def decode_blocks(payloads: list[bytes]) -> tuple[list[np.ndarray], list[bytes]]:
    """Ids and carried bytes of each payload. Raises ``Corrupt`` on any damage."""
    found = []
    for p in payloads:
        if len(p) < 28 or p[:4] != MAGIC or zlib.crc32(p[:-4]) != struct.unpack("<I", p[-4:])[0]:
            raise Corrupt("the checksum of a block is wrong")
        _, n, n_ids, n_known, n_table = struct.unpack("<4sIIII", p[:20])
        known = _unpacked(p[20:20 + n_known], n_ids)
        table = zlib.decompress(p[20 + n_known:20 + n_known + n_table])
        found.append((n, known, table, p[20 + n_known + n_table:-8], struct.unpack("<I", p[-8:-4])[0]))
    blocks = [np.zeros(0, np.uint32)] * len(found)
    for group in _groups([x[0] for x in found]):
        got = _decode_group([found[k][3] for k in group], [found[k][0] for k in group],
                            np.array([len(found[k][1]) for k in group]))
        for k, symbols in zip(group, got):
            blocks[k] = found[k][1][symbols]
    for block, x in zip(blocks, found):
        if zlib.crc32(block.astype("<u4").tobytes()) != x[4]:
            raise Corrupt("the ids of a block don't match their checksum")
    return blocks, [x[2] for x in found]
