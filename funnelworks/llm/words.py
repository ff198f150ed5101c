"""Words and shingles of many texts at once, as 64-bit hashes.

The texts of an Arrow batch lie one after the other in a single byte buffer.
Word borders, word hashes and shingle hashes come from whole-array operations
on slices of that buffer, so no word becomes a Python object.  A word's hash
is the polynomial sum of random 64-bit values of its bytes, taken as the
difference of two prefix sums, then mixed; equal words have equal hashes and
different words differ but for 64-bit collisions.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

U = np.uint64
#: Text bytes worked on at once (one longer text forms a slice of its own).
SLICE_BYTES = 1 << 18

_STEP = 0x9E3779B97F4A7C15 | 3
_BACK = pow(_STEP, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

#: Bytes of words: all but ASCII white space, or ASCII letters, digits and any byte of other characters.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
ASCII_LETTERS = ALPHANUMERIC.copy()
ASCII_LETTERS[128:] = False

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        full = np.full(max(n, SLICE_BYTES), U(base))
        full[0] = 1
        have = _powers[base] = np.cumprod(full)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


@dataclass
class Words:
    """The words of ``n`` texts in order; ``first[i]:first[i + 1]`` are text i's."""

    n: int
    data: np.ndarray  # folded bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    sums: np.ndarray  # prefix sums of the polynomial, with a leading 0

    @property
    def text_no(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return self.spans(self.start, self.end)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges."""
        if not len(start):
            return np.zeros(0, U)
        value = (self.sums[end] - self.sums[start]) * _power(_BACK, int(start.max()) + 1)[start]
        return mix64(value + (end - start).astype(U))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and borders of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    _, borders, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    borders = np.frombuffer(borders, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[borders[0] : borders[-1]], borders - borders[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, borders) of runs of whole texts with at
    most ``limit`` bytes, or a single longer text."""
    data, borders = buffers(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = int(np.searchsorted(borders, borders[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[borders[lo] : borders[hi]], borders[lo : hi + 1] - borders[lo]
        lo = hi


def find_words(data: np.ndarray, borders: np.ndarray, kind: np.ndarray = NOT_SPACE) -> Words:
    """Words of the texts: longest runs of bytes of ``kind``, A-Z lower-cased."""
    data = _FOLD[data]
    return _cut(data, borders, kind[data], np.zeros(0, np.int64))


def _cut(data: np.ndarray, borders: np.ndarray, inside: np.ndarray, cuts: np.ndarray) -> Words:
    """Words: longest runs of bytes ``inside`` that no border and no place in ``cuts`` divides."""
    size, n = len(data), len(borders) - 1
    if not size:
        none = np.zeros(0, np.int64)
        return Words(n, data, none, none, np.zeros(n + 1, np.int64), np.zeros(1, U))
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    for at in (borders[:-1], cuts):
        at = at[at < size]
        opens[at] = inside[at]
    shuts = inside.copy()
    shuts[:-1] &= ~inside[1:] | opens[1:]
    start, end = np.flatnonzero(opens), np.flatnonzero(shuts) + 1
    sums = np.empty(size + 1, U)
    sums[0] = 0
    np.cumsum(_BYTE[data] * _power(_STEP, size), out=sums[1:])
    return Words(n, data, start, end, np.searchsorted(start, borders), sums)


def folded(column: pa.Array) -> pa.Array:
    """Texts in composed form (NFC) and lower case; null counts as empty."""
    composed = [unicodedata.normalize("NFC", t or "") for t in column.to_pylist()]
    return pc.utf8_lower(pa.array(composed, column.type))


#: Scripts written without spaces: each of their characters is a word.
SPACELESS = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")


@cache
def _character_kinds() -> np.ndarray:
    """For each code point: 0 no part of a word, 1 part of one, 2 a word by itself."""
    kinds = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    scripts = "".join(rf"\p{{Script={s}}}" for s in SPACELESS)
    for kind, pattern in ((1, r"[\p{L}\p{M}\p{N}]+"), (2, rf"[[{scripts}]&&[\p{{L}}\p{{M}}\p{{N}}]]+")):
        for found in regex.finditer(pattern, every, regex.V1):
            kinds[found.start() : found.end()] = kind
    return kinds


def find_letters(data: np.ndarray, borders: np.ndarray) -> Words:
    """Words of ``folded`` texts by Unicode: longest runs of letters, marks and
    digits, and each character of a script without spaces by itself."""
    inside, cuts = ASCII_LETTERS[data], np.zeros(0, np.int64)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int64)
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = np.where(size == 2, first & 0x1F, np.where(size == 3, first & 0x0F, first & 0x07))
        for j in (1, 2, 3):
            long = size > j
            code[long] = code[long] << 6 | (data[lead[long] + j] & 0x3F)
        kind = _character_kinds()[code]
        for j in range(4):
            inside[lead[(kind > 0) & (size > j)] + j] = True
        alone = kind == 2
        cuts = np.concatenate((lead[alone], (lead + size)[alone]))
    return _cut(data, borders, inside, cuts)


def white_space(data: np.ndarray) -> np.ndarray:
    """Bytes of characters that Unicode calls white space."""
    space = ~NOT_SPACE[data]
    if (data == 0xC2).any():
        at = np.flatnonzero(data[:-1] == 0xC2)
        at = at[(data[at + 1] == 0x85) | (data[at + 1] == 0xA0)]
        space[at] = space[at + 1] = True
    for lead in (0xE1, 0xE2, 0xE3):
        at = np.flatnonzero(data[:-2] == lead)
        if not len(at):
            continue
        b, c = data[at + 1], data[at + 2]
        if lead == 0xE1:
            hit = (b == 0x9A) & (c == 0x80)
        elif lead == 0xE3:
            hit = (b == 0x80) & (c == 0x80)
        else:
            hit = ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F))
        for j in range(3):
            space[at[hit] + j] = True
    return space


def pre_tokens(data: np.ndarray, borders: np.ndarray) -> Words:
    """The texts cut before every run of white space: each piece is a run of
    white space, if any, with the characters up to the next."""
    n, size = len(borders) - 1, len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(n, data, none, none, np.zeros(n + 1, np.int64), np.zeros(1, U))
    space = white_space(data)
    opens = space.copy()
    opens[1:] &= ~space[:-1]
    opens[borders[:-1][borders[:-1] < borders[1:]]] = True
    start = np.flatnonzero(opens)
    sums = np.empty(size + 1, U)
    sums[0] = 0
    np.cumsum(_BYTE[data] * _power(_STEP, size), out=sums[1:])
    return Words(n, data, start, np.append(start[1:], size), np.searchsorted(start, borders), sums)


def texts_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """The byte ranges, whole characters, as strings."""
    size = end - start
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    places = np.arange(at[-1]) + np.repeat(start - at[:-1], size)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[places])))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the ``k``-word runs of each text, sorted within the
    text, and borders.  A text of 1 to k - 1 words has its whole word
    sequence as its one shingle; a text without words has none."""
    h, first = words.hashes(), words.first
    counts = np.diff(first)
    runs = max(len(h) - k + 1, 0)
    joined = np.zeros(runs, U)
    for j in range(k):
        joined = mix64(joined * U(0xA0761D6478BD642F) + h[j : j + runs])
    out, borders = [], np.zeros(words.n + 1, np.int64)
    for i in range(words.n):
        lo, c = first[i], counts[i]
        if c >= k:
            own = np.sort(joined[lo : lo + c - k + 1])
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif c:
            x = np.zeros(1, U)
            for j in range(c):
                x = mix64(x * U(0xA0761D6478BD642F) + h[lo + j : lo + j + 1])
            own = mix64(x + U(c))
        else:
            own = np.zeros(0, U)
        out.append(own)
        borders[i + 1] = borders[i] + len(own)
    return (np.concatenate(out) if out else np.zeros(0, U)), borders
