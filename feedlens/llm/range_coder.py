"""Static range asymmetric numeral system over arrays: one frequency table, many lanes.

A block deals its symbols to ``lanes`` coder states in turn (symbol i goes to lane i mod lanes),
and all states share one stream of 32-bit words.  Blocks are independent, so many of
them are coded at once, a step of all lanes of all blocks in one array operation.

States are 64 bits, kept in [2^31, 2^63); a step moves at most one word in or out.  A coder
runs from the last symbol to the first, so a reader goes forward.  Every ``STEPS`` steps
the states and the place in the stream are noted: from such a checkpoint a reader can start
in the middle of a block, and the parts between checkpoints can be read side by side.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 32
STEPS = 256                     # steps between two checkpoints
BLOCK = 4 * STEPS * LANES       # symbols of a whole block
LOW, WORD = np.uint64(1 << 31), np.uint64(32)
MOST_BITS = 24
_HEAD = struct.Struct("<4I")    # symbols, words, checkpoints, checksum of all before the words


class Table:
    """Frequencies of symbols, scaled to a power of two; every counted symbol keeps at least 1."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray, bits: int):
        self.symbols, self.freq, self.bits = symbols.astype(np.uint32), freq.astype(np.uint64), bits
        self.start = np.cumsum(self.freq) - self.freq
        self._place = None                  # symbol -> place, made when a coder asks
        if int(self.freq.sum()) != 1 << bits or (self.freq == 0).any():
            raise ValueError("the frequency table does not add up")

    @classmethod
    def of_counts(cls, symbols: np.ndarray, counts: np.ndarray) -> Table:
        """Scaled from counts, in whole numbers; what rounding leaves goes to the commonest symbol."""
        bits = max(16, (len(symbols) - 1).bit_length() + 4)
        if bits > MOST_BITS:
            raise ValueError(f"{len(symbols)} symbols are too many for a table of {MOST_BITS} bits")
        total, room = sum(map(int, counts)), (1 << bits) - len(symbols)
        freq = [1 + int(c) * room // total for c in counts]
        freq[int(np.argmax(counts))] += (1 << bits) - sum(freq)
        return cls(symbols, np.array(freq), bits)

    def to_bytes(self) -> bytes:
        body = struct.pack("<4sII", b"FRQ1", self.bits, len(self.symbols)) + self.symbols.astype("<u4").tobytes() + self.freq.astype("<u4").tobytes()
        return body + struct.pack("<I", zlib.crc32(body))

    @classmethod
    def from_bytes(cls, raw: bytes) -> Table:
        if raw[:4] != b"FRQ1" or struct.unpack("<I", raw[-4:])[0] != zlib.crc32(raw[:-4]):
            raise ValueError("the frequency table is damaged")
        bits, n = struct.unpack_from("<II", raw, 4)
        return cls(np.frombuffer(raw, "<u4", n, 12), np.frombuffer(raw, "<u4", n, 12 + 4 * n), bits)

    def places(self, ids: np.ndarray) -> np.ndarray:
        if self._place is None:
            self._place = np.full(int(self.symbols.max()) + 1, -1, np.int32)
            self._place[self.symbols] = np.arange(len(self.symbols), dtype=np.int32)
        if len(ids) and ids.max() >= len(self._place) or ((at := self._place[ids]) < 0).any():
            raise ValueError("a symbol is not in the frequency table")
        return at

    def slots(self) -> np.ndarray:
        """The place of the symbol that each of the 2^bits slots belongs to."""
        return np.repeat(np.arange(len(self.symbols), dtype=np.uint32), self.freq.astype(np.int64))


def _coded(at: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, which of them are written, states at checkpoints) of ``at`` [blocks, steps, lanes]."""
    blocks, steps, lanes = at.shape
    bits = np.uint64(table.bits)
    x = np.full((blocks, lanes), LOW)
    words, written = np.empty(at.shape, np.uint32), np.empty(at.shape, bool)
    states = np.empty((blocks, -(-steps // STEPS), lanes), np.uint64)
    for t in range(steps - 1, -1, -1):
        f = table.freq[at[:, t]]
        full = x >= f << (np.uint64(63) - bits)
        words[:, t], written[:, t] = x.astype(np.uint32), full
        x = np.where(full, x >> WORD, x)
        q = x // f
        x = (q << bits) + (x - q * f) + table.start[at[:, t]]
        if t % STEPS == 0:
            states[:, t // STEPS] = x
    return words, written, states


def encode(ids: np.ndarray, table: Table, block: int = BLOCK, lanes: int = LANES) -> list[bytes]:
    """``ids`` as coded blocks; all but the last hold ``block`` symbols."""
    if not len(ids):
        return []
    whole = len(ids) // block * block
    tail = ids[whole:]
    fill = -len(tail) % lanes                           # the last step is filled with the commonest symbol
    common = table.symbols[int(table.freq.argmax())]
    parts = [(ids[:whole].reshape(-1, block), block)] if whole else []
    if len(tail):
        parts.append((np.append(tail, np.full(fill, common, ids.dtype)).reshape(1, -1), len(tail)))
    out = []
    for rows, n in parts:
        words, written, states = _coded(table.places(rows.ravel()).reshape(len(rows), -1, lanes), table)
        used = np.cumsum(written.sum(2), 1)
        for b, row in enumerate(rows):
            points = []
            for c, state in enumerate(states[b]):
                mine = row[c * STEPS * lanes:min((c + 1) * STEPS * lanes, n)]
                points.append(struct.pack("<II", int(used[b, c * STEPS - 1]) if c else 0, zlib.crc32(mine.astype("<u4"))) + state.astype("<u8").tobytes())
            points = b"".join(points)
            got = words[b][written[b]].astype("<u4").tobytes()
            check = zlib.crc32(points, zlib.crc32(struct.pack("<3I", n, len(got) // 4, len(states[b]))))
            out.append(_HEAD.pack(n, len(got) // 4, len(states[b]), check) + points + got)
    return out


class Block:
    """A coded block: its head, checkpoints and words."""

    def __init__(self, raw, lanes: int = LANES):
        self.n, n_words, n_points, check = _HEAD.unpack_from(raw)
        size = 8 + 8 * lanes
        points = bytes(raw[_HEAD.size:_HEAD.size + n_points * size])
        if zlib.crc32(points, zlib.crc32(bytes(raw[:12]))) != check or len(raw) < _HEAD.size + len(points) + 4 * n_words:
            raise ValueError("a coded block is damaged")
        kind = np.dtype([("at", "<u4"), ("crc", "<u4"), ("states", "<u8", (lanes,))])
        self.points = np.frombuffer(points, kind)
        self.words = np.frombuffer(raw, "<u4", n_words, _HEAD.size + len(points))


def decode(parts: list[tuple[Block, int]], table: Table, slots: np.ndarray, lanes: int = LANES) -> list[np.ndarray]:
    """The symbols from each (block, checkpoint) up to the next checkpoint; all are read side by side."""
    each = STEPS * lanes
    sizes = np.array([min(each, b.n - c * each) for b, c in parts], np.int64)
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(parts)
    for n in np.unique(sizes):
        mine = np.flatnonzero(sizes == n)
        for k, row in zip(mine, _decoded([parts[i] for i in mine], -(-int(n) // lanes), table, slots, lanes), strict=True):
            block, c = parts[k]
            out[k] = row[:n]
            if zlib.crc32(out[k].astype("<u4")) != int(block.points["crc"][c]):
                raise ValueError("decoded symbols do not match their checksum")
    return out


def _decoded(parts, steps: int, table: Table, slots: np.ndarray, lanes: int) -> np.ndarray:
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    blocks = {id(b): b for b, _ in parts}
    begin, total = {}, 0
    for key, b in blocks.items():
        begin[key] = total
        total += len(b.words)
    words = np.concatenate([*(b.words for b in blocks.values()), np.zeros(1, "<u4")])
    at = np.array([begin[id(b)] + int(b.points["at"][c]) for b, c in parts], np.int64)
    x = np.stack([b.points["states"][c] for b, c in parts]).astype(np.uint64)
    out = np.empty((len(parts), steps, lanes), np.uint32)
    for t in range(steps):
        slot = x & mask
        s = slots[slot]
        out[:, t] = s
        x = table.freq[s] * (x >> bits) + slot - table.start[s]
        low = x < LOW
        taken = np.cumsum(low, 1)
        place = (at[:, None] + taken - 1)[low]
        x[low] = (x[low] << WORD) | words[np.minimum(place, total)]
        at += taken[:, -1]
    return table.symbols[out.reshape(len(parts), -1)]
