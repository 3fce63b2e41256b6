"""Counting quotient filters on numpy arrays: lossless, compact, mergeable counters of integer keys.

A key of `bits` bits goes through an invertible permutation, which spreads any keys evenly. The high bits of the
result, its quotient, name a slot; the rest, the full remainder, is stored in that slot's run. A filter is therefore
its sorted permuted keys, written as the length of each slot's run, the remainders and the counts. As the remainder
is whole and the permutation has an inverse, keys come back exactly. Filters of several shards merge like
sorted lists. The highest bits of the quotient cut a filter into blocks, which are dealt out and merged alone.
"""

from __future__ import annotations

import struct

import numpy as np

_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_HEAD = struct.Struct("<BIII")
_FULL = 255


class Permutation:
    """A bijection of the integers of `bits` bits: products with odd numbers, and shifts of at least half the bits."""

    def __init__(self, bits: int):
        self.bits = bits
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.uint64((bits + 1) // 2)
        self.odd = [np.uint64(x & int(self.mask)) for x in _ODD]
        self.inverse = [np.uint64(pow(int(x), -1, 1 << bits)) for x in self.odd]

    def forth(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(np.uint64)
        for odd in self.odd:
            x = (x * odd) & self.mask
            x ^= x >> self.shift
        return x

    def back(self, permuted: np.ndarray) -> np.ndarray:
        x = permuted.copy()
        for inverse in reversed(self.inverse):
            x ^= x >> self.shift
            x = (x * inverse) & self.mask
        return x


def merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")  # runs that are sorted already are merged
    keys = keys[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[heads], np.add.reduceat(counts[order], heads)


def _bytes(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Small numbers in a byte each, and the large ones apart."""
    large = values >= _FULL
    return np.where(large, _FULL, values).astype(np.uint8).tobytes(), values[large].astype("<u8")


def encode(permuted: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """A block: sorted distinct keys, of which the lowest `width` bits are not implied by the block."""
    n = len(permuted)
    slot_bits = min(width, max(0, n.bit_length() - 1))
    low = np.uint64(width - slot_bits)
    inside = permuted & np.uint64((1 << width) - 1)
    runs, long_runs = _bytes(np.bincount((inside >> low).astype(np.int64), minlength=1 << slot_bits))
    rest = inside & np.uint64((1 << int(low)) - 1)
    size = (int(low) + 7) // 8
    remainders = np.ascontiguousarray(rest.astype("<u8").view(np.uint8).reshape(n, 8)[:, :size]).tobytes()
    times, many = _bytes(counts)
    return b"".join([_HEAD.pack(slot_bits, n, len(long_runs), len(many)), runs, long_runs.tobytes(), remainders, times, many.tobytes()])


def decode(block: bytes, width: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The permuted keys of a block with this number, in order, and their counts."""
    slot_bits, n, n_long, n_many = _HEAD.unpack_from(block)
    at = _HEAD.size

    def read(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(block, dtype=dtype, count=count, offset=at)
        at += out.nbytes
        return out

    def whole(small: np.ndarray, count: int) -> np.ndarray:
        out = small.astype(np.int64)
        out[small == _FULL] = read("<u8", count)
        return out

    runs = whole(read("u1", 1 << slot_bits), n_long)
    size = (width - slot_bits + 7) // 8
    rest = np.zeros((n, 8), dtype=np.uint8)
    rest[:, :size] = read("u1", n * size).reshape(n, size)
    counts = whole(read("u1", n), n_many)
    slots = np.repeat(np.arange(1 << slot_bits, dtype=np.uint64), runs)
    inside = (slots << np.uint64(width - slot_bits)) | rest.reshape(-1).view("<u8").astype(np.uint64)
    return inside | (np.uint64(number) << np.uint64(width)), counts


def blocks(permuted: np.ndarray, counts: np.ndarray, bits: int, block_bits: int) -> list[tuple[int, bytes]]:
    """(number, block) for each block of a filter that holds keys; permuted: sorted and distinct."""
    if not len(permuted):
        return []
    width = bits - block_bits
    number = (permuted >> np.uint64(width)).astype(np.int64)
    heads = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    ends = np.append(heads[1:], len(number))
    return [(int(number[a]), encode(permuted[a:b], counts[a:b], width)) for a, b in zip(heads.tolist(), ends.tolist(), strict=True)]
