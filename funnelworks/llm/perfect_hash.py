"""Minimal perfect hash of pairs of 64-bit hashes.

Each level has a bit array of twice its keys; a key alone at its place there
is settled, the others go on to the next level.  A key's slot is the number
of set bits before its own, so n keys have the slots 0 .. n - 1 and take some
four bits each.  Places depend on both hashes, so that two keys part sooner
or later unless both are equal.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

from funnelworks.llm.words import U, mix64

_HEAD = struct.Struct("<8sII")  # magic, crc32 of the rest, levels
MAGIC = b"MPHASH01"
_SEED = 0x9E3779B97F4A7C15


def _places(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = U((level + 1) * _SEED & 0xFFFFFFFFFFFFFFFF)
    return (mix64(first + mix64(second + seed)) % U(size)).astype(np.int64)


class PerfectHash:
    """``sizes``: bits of each level, whole words; ``bits``: all levels' words."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))

    def __len__(self) -> int:
        return int(self.before[-1])

    @classmethod
    def build(cls, first: np.ndarray, second: np.ndarray) -> PerfectHash:
        """From distinct pairs of unsigned 64-bit values."""
        sizes, words = [], []
        while len(first):
            size = -(-2 * len(first) // 64) * 64
            at = _places(first, second, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            rest = ~alone[at]
            first, second = first[rest], second[rest]
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, "<u8"))

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Slots of pairs; any slot, or -1, for pairs it wasn't built from."""
        out = np.full(len(first), -1, np.int64)
        open_ = np.arange(len(first))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(open_):
                break
            at = _places(first[open_], second[open_], level, size) + self.starts[level]
            word, bit = self.bits[at >> 6], (at & 63).astype(U)
            hit = (word >> bit) & U(1) == 1
            below = np.bitwise_count(word[hit] & ((U(1) << bit[hit]) - U(1)))
            out[open_[hit]] = self.before[at[hit] >> 6] + below
            open_ = open_[~hit]
        return out


def dump(index: PerfectHash, columns: list[np.ndarray]) -> bytes:
    """The hash and 8-byte columns by slot."""
    body = b"".join([index.sizes.astype("<i8").tobytes(), struct.pack("<Q", len(index.bits)), index.bits.astype("<u8").tobytes()])
    body += b"".join(np.ascontiguousarray(c).view("<u8").tobytes() for c in columns)
    return _HEAD.pack(MAGIC, zlib.crc32(body), len(index.sizes)) + body


def load(data: bytes, columns: int) -> tuple[PerfectHash, list[np.ndarray]]:
    magic, crc, levels = _HEAD.unpack_from(data)
    body = memoryview(data)[_HEAD.size :]
    if magic != MAGIC or zlib.crc32(body) != crc:
        raise ValueError("damaged index shard")
    sizes = np.frombuffer(body, "<i8", levels)
    (n,) = struct.unpack_from("<Q", body, 8 * levels)
    at = 8 * levels + 8
    index = PerfectHash(sizes, np.frombuffer(body, "<u8", n, at))
    at += 8 * n
    return index, [np.frombuffer(body, "<u8", len(index), at + 8 * len(index) * i) for i in range(columns)]
