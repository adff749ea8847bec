"""Texts of an Arrow batch as numpy arrays: words, hashes and shingles without Python strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 2 << 20  # text handled at once; bounds the arrays of a task

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

BASE = 0x9E3779B97F4A7C15
BASE_2 = 0xD1342543DE82EF95
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows of about ``limit`` bytes: rows, bytes, offsets."""
    data, offsets = buffers(batch.column(batch.schema.names.index(text)))
    first, rows = 0, batch.num_rows
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(rows, max(last, first + 1))
        yield (
            batch.slice(first, last - first),
            data[offsets[first] : offsets[last]],
            offsets[first : last + 1] - offsets[first],
        )
        first = last


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^(n-1) modulo 2^64 and their inverses."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, PIECE_BYTES + 64)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            table = np.full(size, b, dtype=np.uint64)
            table[0] = 1
            out.append(np.cumprod(table))
        have = _POWERS[base] = tuple(out)
    return have


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """64-bit hash of the bytes of each span, from prefix sums of a polynomial."""
    up, down = powers(len(data) + 1, base)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(BASE_2))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``; words end at the row's end."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    blank = _BLANK[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = blank[:-1], blank[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = True
    after[edges - 1] = True
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(~blank & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word with A-Z lower-cased, and its row."""
    starts, ends, row = words(data, offsets)
    return span_hashes(_LOWER[data], starts, ends), row


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per row.

    A row with fewer words than ``width`` has its whole sequence as one shingle, a row
    without words has none.
    """
    h, row = word_hashes(data, offsets)
    count = np.bincount(row, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(count)])
    factor = np.uint64(BASE_2)
    if len(h) >= width:
        rolled = h[: len(h) - width + 1].copy()
        for j in range(1, width):
            rolled *= factor
            rolled += h[j : len(h) - width + 1 + j]
        rolled = mix(rolled)
    out = []
    for i, n in enumerate(count):
        a = first[i]
        if n >= width:
            s = np.sort(rolled[a : a + n - width + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif n:
            whole = h[a : a + 1].copy()
            for j in range(1, n):
                whole *= factor
                whole += h[a + j]
            out.append(mix(whole + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
