"""Counting quotient filters that lose nothing: exact counts of packed word-id n-grams in few bytes.

An n-gram of word ids, with its language, is a number of a fixed width. A Feistel network permutes these
numbers invertibly, so that they lie evenly and can be had back. The top bits of a permuted number name its
shard; the next ones are the quotient, which is not stored but told by two bit vectors (which quotients
occur, and which slot ends a quotient's run); all other bits are the remainder, stored in full. Equal numbers
share a slot with a counter of one byte; larger counts follow in a list. So a filter is a sorted list of exact
numbers and counts, and filters of the same shard are merged by their order.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<IBBI")  # slots, quotient bits, shard bits, large counts
_MANY = 255


def _round(half: np.ndarray, key: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (half + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
    return x >> np.uint64(64 - bits)


#: Keys of the rounds of the permutation.
_KEYS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)


def _permuted(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    for key in _KEYS:
        left, right = right, left ^ _round(right, key, bits)
    return left, right


def _restored(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    for key in reversed(_KEYS):
        left, right = right ^ _round(left, key, bits), left
    return left, right


class Layout:
    """How n-grams of ids below 2^id_bits, with a language below 2^lang_bits, become permuted numbers.

    A number is kept as `top`, its first 64 bits from the left, and `low`, the others (zero where 64 do)."""

    def __init__(self, n: int, id_bits: int, lang_bits: int):
        self.n, self.id_bits, self.lang_bits = n, id_bits, lang_bits
        width = n * id_bits + lang_bits
        self.tail = n // 2  # words of the right half, where one number of 64 bits is too small
        self.narrow = width <= 64
        if self.narrow:
            self.half = max(4, (width + 1) // 2)
        else:
            self.half = -(-max(self.tail * id_bits, (n - self.tail) * id_bits + lang_bits) // 4) * 4
        self.bits = 2 * self.half
        if self.half > 64:
            raise ValueError(f"{n} word ids of {id_bits} bits do not fit")

    def pack(self, words: list[np.ndarray], lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = np.uint64(self.id_bits)
        parts = []
        for own, number in ((words[: self.n - self.tail], lang.astype(np.uint64)), (words[self.n - self.tail :], np.zeros(len(lang), np.uint64))):
            for w in own:
                number = number << step | w
            parts.append(number)
        left, right = parts
        h = np.uint64(self.half)
        if self.narrow:
            whole = left << np.uint64(self.tail * self.id_bits) | right
            left, right = whole >> h, whole & np.uint64((1 << self.half) - 1)
        left, right = _permuted(left, right, self.half)
        if self.bits <= 64:
            return left << np.uint64(64 - self.half) | right << np.uint64(64 - self.bits), np.zeros(len(left), np.uint64)
        rest = self.bits - 64
        top = (left << np.uint64(64 - self.half) if self.half < 64 else left) | right >> np.uint64(rest)
        return top, right & np.uint64((1 << rest) - 1)

    def unpack(self, top: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words as columns of a matrix, and the languages."""
        left = top >> np.uint64(64 - self.half)
        mask = np.uint64((1 << self.half) - 1)
        if self.bits <= 64:
            right = top >> np.uint64(64 - self.bits) & mask
        else:
            right = (top << np.uint64(self.bits - 64) | low) & mask if self.bits < 128 else low
        left, right = _restored(left, right, self.half)
        step, field = np.uint64(self.id_bits), np.uint64((1 << self.id_bits) - 1)
        if self.narrow:
            whole = left << np.uint64(self.half) | right
            cut = np.uint64(self.tail * self.id_bits)
            left, right = whole >> cut, whole & ((np.uint64(1) << cut) - np.uint64(1))
        words = np.empty((len(top), self.n), np.int64)
        for k in reversed(range(self.n)):
            if k >= self.n - self.tail:
                words[:, k], right = right & field, right >> step
            else:
                words[:, k], left = left & field, left >> step
        return words, left.astype(np.int64)


def counted(top: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers in order, and their counts."""
    order = np.argsort(top, kind="stable")
    top, low = top[order], low[order]
    if len(top) and np.any((top[1:] == top[:-1]) & (low[1:] < low[:-1])):
        again = np.lexsort((low, top))
        top, low, order = top[again], low[again], order[again]
    first = np.flatnonzero(np.concatenate(([True], (top[1:] != top[:-1]) | (low[1:] != low[:-1])))) if len(top) else np.empty(0, np.int64)
    if counts is None:
        n = np.diff(np.append(first, len(top)))
    else:
        n = np.add.reduceat(counts[order], first) if len(first) else np.empty(0, np.int64)
    return top[first], low[first], n.astype(np.int64)


def written(layout: Layout, shard_bits: int, top: np.ndarray, low: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter of one shard's distinct numbers in order."""
    wide = min(layout.bits, 64)
    quotient_bits = max(0, min(int(len(top)).bit_length(), wide - shard_bits))
    while (wide - shard_bits - quotient_bits) % 8 and quotient_bits:
        quotient_bits -= 1  # whole bytes of remainder
    skip = shard_bits + quotient_bits
    own = top << np.uint64(shard_bits) if shard_bits < 64 else np.zeros_like(top)
    quotient = (own >> np.uint64(64 - quotient_bits)).astype(np.int64) if quotient_bits else np.zeros(len(top), np.int64)
    remainder = top >> np.uint64(64 - wide)
    if wide - skip < 64:
        remainder = remainder & np.uint64((1 << (wide - skip)) - 1)
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotient] = True
    run_end = np.append(quotient[1:] != quotient[:-1], True)
    large = counts >= _MANY
    planes = [
        np.packbits(occupied).tobytes(),
        np.packbits(run_end).tobytes(),
        remainder.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-(wide - skip) // 8)].tobytes(),
        low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : max(0, layout.bits - 64) // 8].tobytes(),
        np.where(large, _MANY, counts).astype(np.uint8).tobytes(),
        counts[large].astype("<u8").tobytes(),
    ]
    return _HEAD.pack(len(top), quotient_bits, shard_bits, int(large.sum())) + b"".join(planes)


def read(layout: Layout, shard: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers in order, and their counts."""
    n, quotient_bits, shard_bits, many = _HEAD.unpack_from(data)
    wide = min(layout.bits, 64)
    at = _HEAD.size

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(data, np.uint8, size, at - size)

    def numbers(width: int) -> np.ndarray:
        padded = np.zeros((n, 8), np.uint8)
        padded[:, :width] = take(n * width).reshape(n, width)
        return padded.view("<u8").ravel()

    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << quotient_bits) // 8)), count=1 << quotient_bits))
    run_end = np.unpackbits(take(-(-n // 8)), count=n)
    left_over = wide - shard_bits - quotient_bits
    remainder = numbers(-(-left_over // 8))
    low = numbers(max(0, layout.bits - 64) // 8)
    counts = take(n).astype(np.int64)
    counts[counts == _MANY] = np.frombuffer(data, "<u8", many, at).astype(np.int64)
    quotient = occupied[np.cumsum(run_end) - run_end].astype(np.uint64)
    number = remainder
    if left_over < 64:
        number = number | quotient << np.uint64(left_over)
    if shard_bits:
        number = number | np.uint64(shard) << np.uint64(wide - shard_bits)
    return number << np.uint64(64 - wide), low, counts
