"""64-bit hashes of all words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

from .common import mix64, worker_cache

BASE = 0x9E3779B97F4A7C15 | 1
PART = 1 << 18
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2 ** 64."""
    cache = worker_cache()
    have = cache.get("powers")
    if have is None or len(have[0]) < n:
        n = max(n, PART + (1 << 17))
        have = tuple(np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(n - 1, b, dtype=np.uint64)])) for b in (BASE, pow(BASE, -1, 1 << 64)))
        if n <= 4 * PART:
            cache["powers"] = have
    return have[0][:n], have[1][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (separated by 0x20 and 0x09-0x0D) of all texts, end to end, and each text's number of words.

    A word's hash depends on its bytes alone: the polynomial of its bytes in an odd base modulo 2 ** 64, read off prefix sums, then mixed
    with its length.  Texts are joined into parts of bounded size that end at a separator (a longer word is a part of its own).
    """
    data = b" ".join(texts) + b" "
    bounds = np.cumsum([len(t) + 1 for t in texts])
    hashes, starts_at, a = [], [], 0
    while a < len(data):
        b = a + PART
        if b < len(data):
            cut = next((k for k in range(b, min(b + 65536, len(data))) if _SPACE[data[k]]), None)
            if cut is None:
                cut = min((k for k in (data.find(c, b) for c in (b" ", b"\n", b"\t", b"\x0b", b"\x0c", b"\r")) if k >= 0), default=len(data) - 1)
            b = cut + 1
        part = np.frombuffer(data, dtype=np.uint8, count=min(b, len(data)) - a, offset=a)
        blank = _SPACE[part]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if not blank[0]:
            edge = np.concatenate([[0], edge])
        start, end = edge[0::2], edge[1::2]  # a part ends with a separator
        power, inverse = _powers(len(part) + 1)
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:len(part)], out=total[1:])
        hashes.append(mix64((total[end] - total[start]) * inverse[start] ^ (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        starts_at.append(start + a)
        a = min(b, len(data))
    at = np.concatenate(starts_at) if starts_at else np.empty(0, dtype=np.int64)
    counts = np.diff(np.concatenate([[0], np.searchsorted(at, bounds)])) if len(texts) else np.empty(0, dtype=np.int64)
    return (np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)), counts


def split_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """The word hashes of each text."""
    hashes, counts = word_hashes(texts)
    return np.split(hashes, np.cumsum(counts)[:-1]) if len(texts) else []
