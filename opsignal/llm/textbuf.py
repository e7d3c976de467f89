"""Vectorised views of Arrow text columns: words, lines and their 64-bit hashes.

Everything works on the raw UTF-8 bytes of a column; no Python object is made per
word. Hashes are polynomials modulo 2**64 over a fixed random table of byte values,
finished by a mixing step, so that equal byte sequences get equal hashes in every
task, and unequal ones differ but for a chance of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)

#: White space: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
#: Everything in ASCII but letters and digits.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = [not chr(i).isalnum() for i in range(128)]

PIECE_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                ups = np.full(size, _BASE, np.uint64)
                downs = np.full(size, _BASE_INVERSE, np.uint64)
                ups[0] = downs[0] = 1
                cls.up, cls.down = np.cumprod(ups), np.cumprod(downs)
        return cls.up, cls.down


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, bytes)`` of a string column; nulls are empty texts."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, offsets, bytes)`` of runs of whole texts of about ``limit`` bytes."""
    offsets, data = column_bytes(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, offsets[row : end + 1] - offsets[row], data[offsets[row] : offsets[end]]
        row = end


@dataclass
class Tokens:
    """Runs of bytes between separators. ``first[d]:first[d + 1]`` are those of text ``d``."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def _runs(offsets: np.ndarray, data: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~separator[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hash of every byte range, wherever it stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    out = np.empty(len(starts), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):  # stretches of ranges, so that a very long text needs no more memory
            low = starts[i]
            j = max(i + 1, int(np.searchsorted(starts, low + PIECE_BYTES)))
            high = ends[i:j].max()
            up, down = _Powers.upto(int(high - low) + 1)
            total = np.zeros(high - low + 1, np.uint64)
            np.cumsum(values[data[low:high]] * up[: high - low], out=total[1:])
            s, e = starts[i:j] - low, ends[i:j] - low
            out[i:j] = mix((total[e] - total[s]) * down[s])
            i = j
    return out


def tokens(offsets: np.ndarray, data: np.ndarray, separator: np.ndarray, values: np.ndarray) -> Tokens:
    starts, ends = _runs(offsets, data, separator)
    return Tokens(starts, ends, range_hashes(data, starts, ends, values), np.searchsorted(starts, offsets))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes; of the whole sequence, if it is shorter."""
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    with np.errstate(over="ignore"):
        total = np.full(n - size + 1, size, np.uint64)
        for k in range(size):
            total = total * np.uint64(_BASE) + words[k : n - size + 1 + k]
        return mix(total)


def run_sums(hashes: np.ndarray) -> np.ndarray:
    """Prefix sums by which ``run_hash`` hashes any run of values."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * _Powers.upto(len(hashes) + 1)[0][: len(hashes)], out=total[1:])
    return total


def run_hash(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    down = _Powers.upto(len(total))[1]
    with np.errstate(over="ignore"):
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
