"""Adaptive context-mixing range coder for blocks of token ids.

Three predictions of the next id compete: of order 2 and order 1 (the id that last followed the same two or one ids in the
block) and of order 0 (the id that the block repeats most at the moment). Which of them hits, if any, is one symbol whose
probabilities are mixed from three adaptive tables (by the confidence of the order-2, the order-1 and the order-0 prediction)
with weights that learn which table was right. An id that none of them hits is coded by its frequency rank: the rank's
magnitude as a symbol mixed from an order-0 and an order-1 table, then the rank's remaining bits.

Blocks are reset independently: each is coded from the same starting state, so any one is decoded alone with its segment's
rank table, and carries the CRC-32 of its ids. All arithmetic is on integers, so every machine makes the same bytes. numpy
steps through the ids of up to LANES blocks side by side.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Blocks coded side by side.
LANES = 2048
#: Entries of a block's order-1 and order-2 tables (4 bytes each).
ENTRIES = 4096

_HEADER = struct.Struct("<II")  # ids, CRC-32 of the ids
_TOP, _BOTTOM = np.uint32(1 << 24), np.uint32(1 << 16)
_HIT2, _HIT1, _HIT0, _MISS = range(4)
_LOW_BITS = 12  # bits of a rank that are coded at once
_U8, _U24 = np.uint32(8), np.uint32(24)


def rank_table(ids: np.ndarray) -> np.ndarray:
    """The distinct ids of a segment, most frequent first (ties: smallest id)."""
    distinct, counts = np.unique(ids, return_counts=True)
    return distinct[np.argsort(-counts, kind="stable")].astype(np.uint32)


class _Coder:
    """Range coders of many lanes; ``source`` is None when encoding."""

    def __init__(self, lanes: int, room: int, source: np.ndarray | None = None, at: np.ndarray | None = None):
        self.low = np.zeros(lanes, np.uint32)
        self.range = np.full(lanes, 0xFFFFFFFF, np.uint32)
        self.source = source
        if source is None:
            self.at = np.arange(lanes, dtype=np.int64) * room
            self.out = np.empty(lanes * room, np.uint8)
        else:
            self.at, self.code = at, np.zeros(lanes, np.uint32)
            for _ in range(4):
                self.code = (self.code << _U8) | source[self.at]
                self.at += 1

    def symbol(self, lanes: np.ndarray, weights: np.ndarray, symbol: np.ndarray | None) -> np.ndarray:
        """Code a symbol with the given (lanes x symbols) weights, all above zero and below 2^16 in sum."""
        upto = np.cumsum(weights, axis=1, dtype=np.uint32)
        step = self.range[lanes] // upto[:, -1]
        row = np.arange(len(lanes))
        if symbol is None:
            value = np.minimum((self.code[lanes] - self.low[lanes]) // step, upto[:, -1] - np.uint32(1))
            symbol = (upto <= value[:, None]).sum(axis=1)
        own = weights[row, symbol].astype(np.uint32)
        self._narrow(lanes, step * (upto[row, symbol] - own), step * own)
        return symbol

    def number(self, lanes: np.ndarray, bits: np.ndarray, value: np.ndarray | None) -> np.ndarray:
        """Code a number below 2^bits (at most 2^16), all alike."""
        step = self.range[lanes] >> bits
        if value is None:
            value = np.minimum((self.code[lanes] - self.low[lanes]) // step, (np.uint32(1) << bits) - np.uint32(1))
        self._narrow(lanes, step * value, step)
        return value

    def _narrow(self, lanes: np.ndarray, above: np.ndarray, width: np.ndarray) -> None:
        low = self.low[lanes] + above
        open_ = np.arange(len(lanes))
        lo, wide = low, width
        while True:
            same = (lo ^ (lo + wide)) < _TOP
            short = ~same & (wide < _BOTTOM)
            if short.any():
                wide = np.where(short, (~lo + np.uint32(1)) & np.uint32(0xFFFF), wide)
                width[open_] = wide
            go = np.flatnonzero(same | short)
            if not len(go):
                break
            open_, lo, wide = open_[go], lo[go], wide[go]
            lane = lanes[open_]
            spot = self.at[lane]
            if self.source is None:
                self.out[spot] = lo >> _U24
            else:
                self.code[lane] = (self.code[lane] << _U8) | self.source.take(spot, mode="clip")
            self.at[lane] = spot + 1
            lo, wide = lo << _U8, wide << _U8
            low[open_], width[open_] = lo, wide
        self.low[lanes], self.range[lanes] = low, width

    def finished(self) -> None:
        for k in (24, 16, 8, 0):
            self.out[self.at] = (self.low >> np.uint32(k)) & np.uint32(255)
            self.at += 1


class _Tables:
    """Adaptive weights of symbols: a row for each lane and context."""

    def __init__(self, lanes: int, contexts: int, symbols: int, start: list[int], step: int, most: int):
        self.rows = np.tile(np.array(start, np.uint32), (lanes * contexts, 1))
        self.first = np.arange(lanes) * contexts
        self.step, self.most = np.uint32(step), most

    def look(self, lanes: np.ndarray, context: np.ndarray) -> np.ndarray:
        self.at = self.first[lanes] + context
        return self.rows.take(self.at, axis=0)

    def learn(self, seen: np.ndarray, symbol: np.ndarray) -> None:
        row = np.arange(len(symbol))
        seen[row, symbol] += self.step
        full = np.flatnonzero(seen.sum(axis=1) > self.most)
        if len(full):
            seen[full] = (seen[full] >> np.uint32(1)) | np.uint32(1)
        self.rows[self.at] = seen


def _code(coder: _Coder, sizes: np.ndarray, ranks: np.ndarray, encoding: bool, width: int) -> None:
    """Code ``ranks`` (ids x lanes), filled in when decoding; lanes are sorted by falling size."""
    n, longest = len(sizes), len(ranks)
    active = (np.arange(longest)[:, None] < sizes[None, :]).sum(axis=1)
    every = np.arange(n)
    tables = np.zeros((2, n * ENTRIES), np.uint32)  # rank + 1 and confidence (low 4 bits) after one and two ids
    first = every * ENTRIES
    common, strength = np.zeros(n, np.uint32), np.zeros(n, np.int64)
    by2 = _Tables(n, 16, 4, [2, 1, 1, 8], 24, 1000)
    by1 = _Tables(n, 16, 4, [1, 2, 1, 8], 24, 1000)
    by0 = _Tables(n, 16, 4, [1, 1, 1, 8], 24, 1000)
    trust = np.full((3, n), 8, np.int32)
    size0 = _Tables(n, 1, width + 1, [4] * (width + 1), 32, 8000)
    size1 = _Tables(n, width + 1, width + 1, [1] * (width + 1), 32, 8000)
    prior, one, two = np.zeros(n, np.int64), np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    for t in range(longest):
        m = int(active[t])
        lanes = every[:m]
        k1 = first[:m] + ((one[:m] * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64)
        k2 = first[:m] + (((one[:m] * np.uint32(0x85EBCA6B)) ^ (two[:m] * np.uint32(0xC2B2AE35))) * np.uint32(0x9E3779B1)
                          >> np.uint32(20)).astype(np.int64)
        e1, e2 = tables[0].take(k1), tables[1].take(k2)
        p1, p2, p0 = e1 >> np.uint32(4), e2 >> np.uint32(4), common[:m]
        c1, c2 = (e1 & np.uint32(15)).astype(np.int64), (e2 & np.uint32(15)).astype(np.int64)
        c0 = np.minimum(strength[:m], 3) * 4 + (p1 == p2) * 2 + (p1 == p0)
        seen = by2.look(lanes, c2), by1.look(lanes, c1), by0.look(lanes, c0)
        own = trust[:, :m]
        mixed = (seen[0] * own[0][:, None].astype(np.uint32) + seen[1] * own[1][:, None].astype(np.uint32)
                 + seen[2] * own[2][:, None].astype(np.uint32))
        if encoding:
            value = ranks[t, :m] + np.uint32(1)
            hit = np.where(value == p2, _HIT2, np.where(value == p1, _HIT1, np.where(value == p0, _HIT0, _MISS)))
            coder.symbol(lanes, mixed, hit)
        else:
            hit = coder.symbol(lanes, mixed, None)
            value = np.where(hit == _HIT2, p2, np.where(hit == _HIT1, p1, p0))
        row = np.arange(m)
        shares = np.stack([s[row, hit] * np.uint32(4096) // s.sum(axis=1, dtype=np.uint32) for s in seen])
        own += np.where(shares * np.uint32(3) >= shares.sum(axis=0, dtype=np.uint32), 1, -1).astype(np.int32)
        np.clip(own, 1, 20, out=own)
        for table, s in zip((by2, by1, by0), seen):
            table.learn(s, hit)
        miss = np.flatnonzero(hit == _MISS)
        if len(miss):
            s0, s1 = size0.look(miss, np.zeros(len(miss), np.int64)), size1.look(miss, prior[miss])
            if encoding:
                v = value[miss]
                size = np.frexp(v.astype(np.float64))[1] - 1
                rest = v - (np.uint32(1) << size.astype(np.uint32))
            else:
                size = rest = None
            size = coder.symbol(miss, s0 + s1 * np.uint32(2), size)
            size0.learn(s0, size)
            size1.learn(s1, size)
            prior[miss] = size
            low_bits = np.minimum(size, _LOW_BITS).astype(np.uint32)
            high = np.flatnonzero(size > _LOW_BITS)
            part = np.zeros(len(miss), np.uint32)
            if len(high):
                part[high] = coder.number(miss[high], (size[high] - _LOW_BITS).astype(np.uint32),
                                          rest[high] >> np.uint32(_LOW_BITS) if encoding else None)
            low = coder.number(miss, low_bits, rest & ((np.uint32(1) << low_bits) - np.uint32(1)) if encoding else None)
            if not encoding:
                value[miss] = (np.uint32(1) << size.astype(np.uint32)) + (part << np.uint32(_LOW_BITS)) + low
        if not encoding:
            ranks[t, :m] = value - np.uint32(1)
        # A right prediction grows in confidence, a wrong one shrinks and is replaced when it has none left.
        for table, key, entry, guess, sure in ((tables[0], k1, e1, p1, c1), (tables[1], k2, e2, p2, c2)):
            right = guess == value
            kept = right | (sure > 1)
            sure = np.where(right, np.minimum(sure + 1, 15), np.where(kept, sure >> 1, 1)).astype(np.uint32)
            table[key] = (np.where(kept, guess, value) << np.uint32(4)) | sure
        right = value == p0
        replace = ~right & (strength[:m] == 0)
        common[:m] = np.where(replace, value, p0)
        strength[:m] = np.where(replace, 1, np.where(right, np.minimum(strength[:m] + 1, 8), strength[:m] - 1))
        two[:m], one[:m] = one[:m], value


def encode_blocks(blocks: list[np.ndarray], table: np.ndarray) -> list[bytes]:
    """The coded form of each block of ids, all of which are in the rank ``table``."""
    order = np.argsort(table)
    width = int(len(table)).bit_length()
    out: list[bytes] = [b""] * len(blocks)
    for k in range(0, len(blocks), LANES):
        pick = sorted(range(k, min(k + LANES, len(blocks))), key=lambda i: -len(blocks[i]))
        sizes = np.array([len(blocks[i]) for i in pick])
        ranks = np.zeros((int(sizes[0]), len(pick)), np.uint32)
        for lane, i in enumerate(pick):
            ranks[:sizes[lane], lane] = order[np.searchsorted(table, blocks[i], sorter=order)]
        room = int(sizes[0]) * 10 + 16  # two mixed symbols of at most 16 bits, and the rank's bits, with slack
        coder = _Coder(len(pick), room)
        _code(coder, sizes, ranks, True, width)
        coder.finished()
        for lane, i in enumerate(pick):
            ids = np.asarray(blocks[i], "<u4").tobytes()
            out[i] = _HEADER.pack(len(blocks[i]), zlib.crc32(ids)) + coder.out[lane * room:int(coder.at[lane])].tobytes()
    return out


def decode_blocks(coded: list[bytes], table: np.ndarray) -> list[np.ndarray]:
    """The ids of each block; raises ValueError if a block's checksum does not hold."""
    width = int(len(table)).bit_length()
    heads = [_HEADER.unpack_from(c) for c in coded]
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(coded)
    for k in range(0, len(coded), LANES):
        pick = sorted(range(k, min(k + LANES, len(coded))), key=lambda i: -heads[i][0])
        sizes = np.array([heads[i][0] for i in pick])
        raw = np.frombuffer(b"".join(coded[i] for i in pick) + bytes(16), np.uint8)
        lengths = np.array([len(coded[i]) for i in pick])
        coder = _Coder(len(pick), 0, raw, np.cumsum(lengths) - lengths + _HEADER.size)
        ranks = np.zeros((int(sizes[0]), len(pick)), np.uint32)
        _code(coder, sizes, ranks, False, width)
        for lane, i in enumerate(pick):
            own = ranks[:sizes[lane], lane]
            ids = table[np.minimum(own, max(len(table) - 1, 0))] if len(own) else np.zeros(0, np.uint32)
            if zlib.crc32(ids.astype("<u4").tobytes()) != heads[i][1]:
                raise ValueError("a block's checksum does not hold")
            out[i] = ids
    return out
