"""Counting quotient filters: compact, lossless counters for keys of a fixed number of bits.

A key is permuted by a bijection of its own width. The upper bits of the result, the *quotient*, are never stored: they are the place
of the entry. The lower bits, the *remainder*, are stored in full, so the key comes back and two keys never share a counter. Keys
are arrays of one 64-bit lane, or of several (upper first) where they are wider.

A filter here holds the keys of one *shard*, those whose permuted form begins with the shard's bits. Its entries are sorted; as bytes it is
a header, the number of entries of each quotient, the remainders in whole bytes, and the counters in as many bytes as they need.
Sorted filters are merged by one sort of their nearly ordered entries.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from minekit.llm.batches import mixed

_ODD = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_HEADER = struct.Struct("<qBB")


def mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


@dataclass(frozen=True)
class Permutation:
    """A bijection of the numbers of ``bits`` bits, in one lane up to 64 bits and in as many as they need beyond."""

    bits: int

    @property
    def lanes(self) -> int:
        return max(1, self.bits + 63 >> 6)

    @property
    def upper_bits(self) -> int:
        """Bits of the first lane; the others are full."""
        return self.bits - 64 * (self.lanes - 1)

    def _steps(self) -> list[tuple[int, int]]:
        """Lanes in the order in which the others are mixed into them, each with a number of its own."""
        return list(enumerate([*range(self.lanes - 1, -1, -1), self.lanes - 1], 1))

    def _mixed_in(self, lanes: list[np.ndarray], number: int, lane: int) -> None:
        """Changes one lane by a function of the others, which undoes itself."""
        value = np.uint64(number)
        for i, x in enumerate(lanes):
            if i != lane:
                value = mixed(x + value)
        lanes[lane] = lanes[lane] ^ (value & mask(self.upper_bits) if lane == 0 else value)

    def forward(self, lanes: list[np.ndarray]) -> list[np.ndarray]:
        if self.lanes == 1:
            x, shift = lanes[0], np.uint64(self.bits // 2 + 1)
            for odd in _ODD:
                x = (x * np.uint64(odd)) & mask(self.bits)
                x = x ^ (x >> shift)
            return [x]
        lanes = list(lanes)
        for number, lane in self._steps():
            self._mixed_in(lanes, number, lane)
        return lanes

    def backward(self, lanes: list[np.ndarray]) -> list[np.ndarray]:
        if self.lanes == 1:
            x, shift = lanes[0], np.uint64(self.bits // 2 + 1)
            for odd in reversed(_ODD):
                x = x ^ (x >> shift)  # its own inverse, as the shift is over half the width
                x = (x * np.uint64(pow(odd, -1, 1 << self.bits))) & mask(self.bits)
            return [x]
        lanes = list(lanes)
        for number, lane in reversed(self._steps()):
            self._mixed_in(lanes, number, lane)
        return lanes

    def leading(self, permuted: list[np.ndarray], bits: int) -> np.ndarray:
        """The first ``bits`` (at most 32) of permuted keys; fewer where the keys are shorter."""
        bits = min(bits, self.bits)
        if self.lanes == 1:
            return permuted[0] >> np.uint64(self.bits - bits)
        high_bits = self.upper_bits
        if bits <= high_bits:
            return permuted[0] >> np.uint64(high_bits - bits)
        rest = np.uint64(bits - high_bits)
        return (permuted[0] << rest) | (permuted[1] >> (np.uint64(64) - rest))


def summed(lanes: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct keys with their summed counts."""
    if len(counts) == 0:
        return lanes, counts
    order = np.argsort(lanes[0], kind="stable") if len(lanes) == 1 else np.lexsort(lanes[::-1])
    lanes, counts = [x[order] for x in lanes], counts[order]
    fresh = np.zeros(len(counts), bool)
    fresh[0] = True
    for x in lanes:
        fresh[1:] |= x[1:] != x[:-1]
    at = np.flatnonzero(fresh)
    return [x[at] for x in lanes], np.add.reduceat(counts, at)


def encode(permuted: list[np.ndarray], counts: np.ndarray, bits: int, shard_bits: int) -> bytes:
    """The filter of one shard: sorted permuted keys that share their first ``shard_bits`` bits."""
    n = len(counts)
    full_bits = 64 * (len(permuted) - 1)
    # as many quotients as entries, and all beyond the shard's bits from the upper lane
    room = bits - full_bits - shard_bits
    slot_bits = max(0, min(room, max(n - 1, 0).bit_length(), 24))
    remainder_bits = bits - shard_bits - slot_bits
    upper = permuted[0] & mask(room)
    upper_rest = remainder_bits - full_bits
    slots = (upper >> np.uint64(upper_rest)).astype(np.int64) if upper_rest < 64 else np.zeros(n, np.int64)
    runs = np.bincount(slots, minlength=1 << slot_bits)
    remainders = [_narrow(upper & mask(upper_rest), upper_rest)] + [_narrow(x, 64) for x in permuted[1:]]
    widths = _widths(counts)
    return b"".join(
        (
            _HEADER.pack(n, slot_bits, int(runs.max(initial=0)).bit_length() + 7 >> 3),
            _narrow(runs.astype(np.uint64), 8 * (int(runs.max(initial=0)).bit_length() + 7 >> 3)),
            *remainders,
            widths.astype(np.uint8).tobytes(),
            _ragged(counts, widths),
        )
    )


def decode(data: bytes, shard: int, bits: int, shard_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The sorted permuted keys and counts of a filter."""
    n, slot_bits, run_bytes = _HEADER.unpack_from(data)
    at = _HEADER.size
    runs, at = _wide(data, at, 1 << slot_bits, 8 * run_bytes)
    slots = np.repeat(np.arange(1 << slot_bits, dtype=np.uint64), runs.astype(np.int64))
    remainder_bits = bits - shard_bits - slot_bits
    full_lanes = Permutation(bits).lanes - 1
    upper_rest = remainder_bits - 64 * full_lanes
    rest, at = _wide(data, at, n, upper_rest)
    upper = rest if upper_rest >= 64 else (slots << np.uint64(upper_rest)) | rest
    own_bits = upper_rest + slot_bits
    lanes = [upper if own_bits >= 64 else (np.uint64(shard) << np.uint64(own_bits)) | upper]
    for _ in range(full_lanes):
        low, at = _wide(data, at, n, 64)
        lanes.append(low)
    widths = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    at += n
    raw = np.zeros((n, 8), np.uint8)
    raw[np.arange(8) < widths[:, None]] = np.frombuffer(data, np.uint8, int(widths.sum()), at)
    return lanes, raw.view("<i8").reshape(n)


def _narrow(x: np.ndarray, bits: int) -> bytes:
    """Numbers of ``bits`` bits in whole bytes each."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(len(x), 8)[:, : bits + 7 >> 3]).tobytes()


def _wide(data: bytes, at: int, n: int, bits: int) -> tuple[np.ndarray, int]:
    width = bits + 7 >> 3
    raw = np.zeros((n, 8), np.uint8)
    raw[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    return raw.view("<u8").reshape(n).astype(np.uint64), at + n * width


def _widths(counts: np.ndarray) -> np.ndarray:
    """Bytes that each positive count needs."""
    return 1 + sum((counts >= (1 << 8 * i)).astype(np.int64) for i in range(1, 8))


def _ragged(counts: np.ndarray, widths: np.ndarray) -> bytes:
    raw = counts.astype("<i8").view(np.uint8).reshape(len(counts), 8)
    return raw[np.arange(8) < widths[:, None]].tobytes()
