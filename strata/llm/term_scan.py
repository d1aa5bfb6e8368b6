"""Terms of many texts at once, in numpy: maximal runs of ASCII digits and letters and of characters beyond ASCII, only A-Z lower-cased."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A term's bytes lower-cased, every other byte a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_FOLD = np.frombuffer(FOLD, dtype=np.uint8)
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # over lower-cased text, in Java's and RE2's syntax alike


def folded_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The folded bytes of all texts end to end, and where each text ends; a NULL text has no bytes."""
    texts = pc.fill_null(texts, "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return np.empty(0, dtype=np.uint8), ends
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    first = int(np.frombuffer(texts.buffers()[1], dtype=kind, count=1, offset=texts.offset * np.dtype(kind).itemsize)[0])
    return _FOLD[np.frombuffer(texts.buffers()[2], dtype=np.uint8, count=total, offset=first)], ends


def term_places(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, size, row`` of every term in ``data``, whose texts end at ``ends``; no term crosses the end of a text."""
    inside = data != 32
    cuts = np.unique(ends[:-1]) if len(ends) else ends  # where a text begins
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[cuts], after[cuts - 1] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return start, end - start, np.searchsorted(ends, start, side="right")


def joined_terms(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All terms with one blank after each, and where each begins there."""
    at = np.cumsum(size + 1) - size - 1
    index = np.arange(int((size + 1).sum()), dtype=np.int64) + np.repeat(start - at, size + 1)
    out = data[np.minimum(index, len(data) - 1)] if len(data) else np.empty(0, dtype=np.uint8)
    out[at + size] = 32
    return out, at
