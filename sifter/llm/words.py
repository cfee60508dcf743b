"""Words of Arrow text columns as numpy arrays: positions and 64-bit hashes.

A word is a run of bytes other than space and \\x09-\\x0D; those separators
are single bytes in UTF-8, so spans on bytes are spans on code points. Hashes
are polynomials modulo 2^64 over a fixed random value per byte, taken from
prefix sums, then mixed; they depend on the word's bytes alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes worked on at once (one text is never cut).
BLOCK = 1 << 20
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; grown as needed and kept."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        a = np.full(max(n, BLOCK + 1), base, np.uint64)
        a[0] = 1
        have = _POWERS[base] = np.cumprod(a, dtype=np.uint64)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]] if len(offsets) else raw[:0], offsets - (offsets[0] if len(offsets) else 0)


def blocks(offsets: np.ndarray):
    """(first, last) text numbers whose bytes come to about BLOCK."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each text (one more than texts)."""
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = ~_SEPARATOR[data]
    first, last = word[1:-1] & ~word[:-2], word[1:-1] & ~word[2:]
    inner = offsets[1:-1]
    cut = inner[(inner > 0) & (inner < len(data))]  # a word ends where its text ends
    first[cut] = word[1:-1][cut]
    last[cut - 1] = word[1:-1][cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=total[1:])
    h = (total[ends] - total[starts]) * powers(_INVERSE, len(data) + 1)[starts]
    return mixed(h ^ (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, starts: np.ndarray, width: int, base: int = _BASE) -> np.ndarray:
    """A 64-bit hash of the ``width`` words from each of ``starts``."""
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(base, len(words)), out=total[1:])
    return mixed((total[starts + width] - total[starts]) * powers(pow(base, -1, 2**64), len(words) + 1)[starts])
