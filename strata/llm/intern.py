"""Interning of byte strings in an open-addressed numpy table: XXH64 keys, verified byte for byte."""

from __future__ import annotations

import numpy as np
import xxhash

P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))  # XXH64's constants: fixed values
LONG = 32  # from this size on XXH64 works in stripes: such strings, and byte checks of them, go one by one


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def numbers_at(data: np.ndarray) -> np.ndarray:
    """A view whose element ``i`` is the little-endian 64-bit number at byte ``i`` (zeros follow the end)."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[:len(data)] = data
    return np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))


def xxh64(data: np.ndarray, numbers: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of ``data[start:start + size]`` for each pair."""
    h = P5 + size.astype(np.uint64)
    at, short = start.copy(), size < LONG
    for k in range(1, LONG // 8):
        some = np.flatnonzero(short & (size >= 8 * k))
        if not len(some):
            break
        lane = _rotated(numbers[at[some]] * P2, 31) * P1
        h[some] = _rotated(h[some] ^ lane, 27) * P1 + P4
        at[some] += 8
    some = np.flatnonzero(short & (size & 4 > 0))
    h[some] = _rotated(h[some] ^ (numbers[at[some]] & np.uint64(0xFFFFFFFF)) * P1, 23) * P2 + P3
    at[some] += 4
    for k in range(1, 4):
        some = np.flatnonzero(short & (size & 3 >= k))
        h[some] = _rotated(h[some] ^ data[at[some]].astype(np.uint64) * P5, 11) * P1
        at[some] += 1
    h ^= h >> np.uint64(33)
    h *= P2
    h ^= h >> np.uint64(29)
    h *= P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(~short).tolist():
        h[i] = xxhash.xxh64_intdigest(data[start[i]:start[i] + size[i]].tobytes())
    return h


def equal_bytes(data: np.ndarray, numbers: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at ``a`` and at ``b`` are the same."""
    left = np.minimum(size, 8).astype(np.uint64) * np.uint64(8)
    mask = np.where(left < 64, (np.uint64(1) << (left & np.uint64(63))) - np.uint64(1), ~np.uint64(0))
    equal = (numbers[a] ^ numbers[b]) & mask == 0
    for k in range(8, LONG, 8):
        some = np.flatnonzero(equal & (size > k) & (size < LONG))
        if not len(some):
            break
        at = np.minimum(k, size[some] - 8)  # the last eight bytes may overlap those before
        equal[some] = numbers[a[some] + at] == numbers[b[some] + at]
    for i in np.flatnonzero(equal & (size >= LONG) & (a != b)).tolist():
        equal[i] = data[a[i]:a[i] + size[i]].tobytes() == data[b[i]:b[i] + size[i]].tobytes()
    return equal


def intern(data: np.ndarray, start: np.ndarray, size: np.ndarray, keys=xxh64) -> tuple[np.ndarray, np.ndarray]:
    """``(slot, owner)``: each string's slot in the table, and for each slot the first string that took it, or -1.

    Strings share a slot exactly if their bytes are equal: a slot whose key agrees but whose bytes do not is passed over like any other
    taken one.  The table has at least twice as many slots as there are strings, so the probes end.
    """
    n = len(start)
    slots = 1 << max(4, (2 * n - 1).bit_length())
    numbers = numbers_at(data)
    h = keys(data, numbers, start, size)
    at, owner, slot = (h & np.uint64(slots - 1)).astype(np.int64), np.full(slots, -1, dtype=np.int64), np.empty(n, dtype=np.int64)
    todo = np.arange(n)
    while len(todo):
        free = owner[at] < 0
        owner[at[free][::-1]] = todo[free][::-1]  # of several that claim a slot the first stays
        held = owner[at]
        same = (h[held] == h[todo]) & (size[held] == size[todo])
        same[same] = equal_bytes(data, numbers, start[held[same]], start[todo[same]], size[todo[same]])
        slot[todo[same]] = at[same]
        todo, at = todo[~same], (at[~same] + 1) & (slots - 1)
    return slot, owner
