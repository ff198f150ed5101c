"""Static range asymmetric numeral system over token ids, vectorised.

One frequency table, scaled to 2**bits, serves all blocks.  A block's ids are
dealt in turn to ``lanes`` interleaved coders, whose states advance together
as one array; words that overflowing states emit share one stream, in lane
order within a step, so the decoder knows whose word comes next.  A block
holds the states at its start and, every ``every`` steps, a checkpoint
(states and place in the word stream) from which decoding can start, so one
block can be decoded in parts and blocks independently of each other.  The
CRC-32 of the block's ids is checked after decoding a whole block.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

U = np.uint64
_LOW = U(1 << 31)  # states lie in [2**31, 2**63)
_HEAD = struct.Struct("<4sIIIIII")  # magic, ids, lanes, steps between checkpoints, checkpoints, words, crc32 of ids
LANES, BLOCK_IDS, EVERY = 512, 1 << 17, 128


@dataclass
class Table:
    """Scaled frequencies of the symbols 0 .. len(freq) - 1."""

    bits: int
    freq: np.ndarray

    def __post_init__(self):
        self.start = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(U)
        self.wide = self.freq.astype(U)
        self._slots = None

    def slots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbol, its frequency and the place within it, of each slot."""
        if self._slots is None:
            symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq)
            place = np.arange(1 << self.bits, dtype=np.uint32) - self.start.astype(np.uint32)[symbol]
            self._slots = symbol, self.freq.astype(np.uint32)[symbol], place
        return self._slots

    def dump(self) -> bytes:
        """Only symbols in use: number, then symbols and frequencies."""
        used = np.flatnonzero(self.freq)
        return struct.pack("<III", self.bits, len(self.freq), len(used)) + used.astype("<u4").tobytes() + self.freq[used].astype("<u4").tobytes()

    @staticmethod
    def load(data: bytes) -> Table:
        bits, size, n = struct.unpack_from("<III", data)
        both = np.frombuffer(data, "<u4", 2 * n, 12)
        freq = np.zeros(size, np.int64)
        freq[both[:n]] = both[n:]
        return Table(bits, freq)


def scaled(symbols: np.ndarray, counts: np.ndarray, bits: int = 18) -> Table:
    """A table in which every counted symbol has a share of at least one and
    all shares add up to 2**bits (more bits if there are too many symbols)."""
    if not len(symbols):
        symbols, counts = np.zeros(1, np.int64), np.ones(1, np.int64)
    bits = max(bits, int(len(symbols)).bit_length() + 1)
    whole = 1 << bits
    share = np.maximum(1, (counts.astype(float) * (whole / counts.sum())).astype(np.int64))
    order = np.argsort(-share, kind="stable")
    rest = whole - int(share.sum())
    if rest > 0:
        share[order[0]] += rest
    while rest < 0:
        for i in order:
            take = min(int(share[i]) - 1, -(rest * int(share[i]) // whole), -rest)
            share[i] -= take
            rest += take
            if not rest:
                break
        order = np.argsort(-share, kind="stable")
    freq = np.zeros(int(symbols.max()) + 1, np.int64)
    freq[symbols] = share
    return Table(bits, freq)


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = EVERY) -> bytes:
    n = len(ids)
    lanes = max(1, min(lanes, -(-n // 64)))
    steps = -(-n // lanes)
    grid = np.full(steps * lanes, int(np.argmax(table.freq)), np.int64)  # the last step is filled up
    grid[:n] = ids
    grid = grid.reshape(steps, lanes)
    bits = U(table.bits)
    x = np.full(lanes, _LOW)
    words: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    for s in range(steps - 1, -1, -1):
        f, start = table.wide[grid[s]], table.start[grid[s]]
        over = x >= (((_LOW >> bits) << U(32)) * f)
        words.append((x[over] & U(0xFFFFFFFF)).astype("<u4"))
        x = np.where(over, x >> U(32), x)
        q, r = np.divmod(x, f)
        x = (q << bits) + r + start
        if s and s % every == 0:
            marks.append((s, x))
    words.reverse()  # the decoder meets the steps the other way round
    before = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    marks.reverse()
    stream = np.concatenate(words) if words else np.zeros(0, "<u4")
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    parts = [_HEAD.pack(b"RANB", n, lanes, every, len(marks), len(stream), crc), x.astype("<u8").tobytes()]
    for s, state in marks:
        parts += [struct.pack("<Q", int(before[s])), state.astype("<u8").tobytes()]
    return b"".join([*parts, stream.tobytes()])


def decode_block(data: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids first .. last - 1 of a block, started at the nearest checkpoint; a
    whole block is held against its checksum."""
    magic, n, lanes, every, marks, n_words, crc = _HEAD.unpack_from(data)
    if magic != b"RANB":
        raise ValueError("not a block")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, "<u4")
    steps = -(-n // lanes)
    size = 8 * lanes
    at, pos = _HEAD.size, 0
    mark = min(first // lanes // every, marks)
    if mark:
        at += size + (mark - 1) * (8 + size)
        pos = struct.unpack_from("<Q", data, at)[0]
        at += 8
    x = np.frombuffer(data, "<u8", lanes, at).astype(U)
    words = np.frombuffer(data, "<u4", n_words, _HEAD.size + size + marks * (8 + size)).astype(U)
    symbol, freq, place = table.slots()
    low, bits = U((1 << table.bits) - 1), U(table.bits)
    out = np.empty((min(steps, -(-last // lanes)) - mark * every, lanes), "<u4")
    for s in range(len(out)):
        slot = x & low
        out[s] = symbol[slot]
        x = freq[slot] * (x >> bits) + place[slot]
        need = np.flatnonzero(x < _LOW)
        x[need] = (x[need] << U(32)) | words[pos : pos + len(need)]
        pos += len(need)
    skipped = mark * every * lanes
    ids = out.ravel()[first - skipped : last - skipped]
    if (first, last) == (0, n) and zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("checksum of a block differs")
    return ids
