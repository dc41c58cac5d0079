"""Vectorised word and shingle hashing for code that runs inside Spark tasks.

Words are maximal runs of bytes other than blank, tab, LF, VT, FF and CR, with
A-Z lower-cased, so the result depends only on the UTF-8 bytes of a text.  All
work is done on the Arrow buffers of a column; no Python object is made per
word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_SEGMENT_BYTES = 1 << 20
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

END = np.uint64(0x0123456789ABCDEF)     # the token that closes a text
START = np.uint64(0x0FEDCBA987654321)   # context before the first word


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits (murmur finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def chain(context: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of all but its last part, and that part."""
    return mix(context * np.uint64(0x9FB21C651E98DF25) + (nxt ^ np.uint64(0x2545F4914F6CDD1D)))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def _buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def hash_words(column) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all rows in order, number of words of each row)."""
    (hashes,), counts = hash_parts(column)
    return hashes, counts


def hash_parts(column, blank: np.ndarray = _BLANK, prefixes: tuple[int, ...] = ()) -> tuple[list[np.ndarray], np.ndarray]:
    """([hashes of whole words, of their first ``prefixes[0]`` bytes, ...], words of each row);
    ``blank`` tells which bytes part words."""
    offsets, data = _buffers(column)
    n = len(offsets) - 1
    hashes: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)] for _ in range(1 + len(prefixes))]
    counts = np.zeros(n, np.int64)
    row = 0
    while row < n:                              # segments of whole rows, about 1 MB each
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _SEGMENT_BYTES, "right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[last])
        if hi > lo:
            raw = data[lo:hi]
            inside = ~blank[raw]
            begins = inside.copy()
            begins[1:] &= ~inside[:-1]
            ends = inside.copy()
            ends[:-1] &= ~inside[1:]
            edges = offsets[row:last + 1] - lo
            cut = edges[(edges > 0) & (edges < hi - lo)]
            begins[cut] = inside[cut]
            ends[cut - 1] = inside[cut - 1]
            first, past = np.flatnonzero(begins), np.flatnonzero(ends) + 1
            power, inverse = _power_tables(hi - lo)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(_BYTE_CODE[_LOWER[raw]] * power[:hi - lo], out=total[1:])
            for out, size in zip(hashes, (hi - lo, *prefixes), strict=True):
                end = np.minimum(first + size, past)
                h = (total[end] - total[first]) * inverse[first]
                out.append(mix(h + (end - first).astype(np.uint64)))
            counts[row:last] = np.diff(np.searchsorted(first, edges, "left"))
        row = last
    return [np.concatenate(h) for h in hashes], counts


def shingles(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``width`` words, and their number by row.

    A row of fewer words gives one hash of its whole word sequence; a row
    without words gives none.
    """
    starts = np.cumsum(counts) - counts
    n_runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.repeat(starts - (np.cumsum(n_runs) - n_runs), n_runs) + np.arange(n_runs.sum())
    left = np.repeat(starts + counts, n_runs) - first        # words left in the row
    h = np.zeros(len(first), np.uint64)
    for k in range(width):
        more = left > k
        if more.all():
            h = chain(h, words[first + k])
        else:
            h[more] = chain(h[more], words[first[more] + k])
    return h, n_runs
