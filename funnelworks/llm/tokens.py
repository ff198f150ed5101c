"""Token ids of whole texts by the tokenizers library, fast enough in tasks.

A tokenizer that drops white space (its words never span any) gives a text
the ids of its white-space separated chunks one after the other.  Each Python
worker keeps the ids of chunks and their lower-case words that it has met, so
the library is asked once per distinct word; special strings, normalisation and
splitting inside a chunk stay the library's own, but for words with marks
behind them.  A tokenizer with another normaliser or other splits than those
this holds for gets whole texts.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Chunks that a worker remembers, and their bytes at most; when full it begins anew, which costs time only.
MEMO_CHUNKS, MEMO_BYTES = 1_000_000, 64
#: Latin letters up to U+00FF but for two signs and two ordinals, in UTF-8, and
#: the ASCII marks behind them but for ' (of contractions), < and | (of special strings).
_WORD = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:;=-@\[-`{}~]*)")
#: Ids as bytes, by their number; a remembered chunk has no more ids than bytes.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(MEMO_BYTES + 1)]
#: Parts of the normaliser and of the splits that chunks and words rely on.
_NORMAL = ("NFC()", r'Replace(pattern=Regex("\s+"), content=" ")', "Lowercase()")
_SPLITS = (r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", "behavior=Removed, invert=True", "ByteLevel(add_prefix_space=False")
_coders: dict[str, ChunkCoder] = {}


class _Memo(dict):
    """Ids of chunks; those not met yet are asked for."""

    def __init__(self, ask):
        self.ask = ask

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.ask(chunk)
        if len(chunk) <= MEMO_BYTES:
            self[chunk] = ids
        return ids


class ChunkCoder:
    """Ids, as little-endian unsigned 32-bit integers, of whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        normal, splits = str(self.library.normalizer), str(self.library.pre_tokenizer)
        self.chunks = all(x in normal for x in _NORMAL) and all(x in splits for x in _SPLITS)
        self.memo = _Memo(self._ask)
        self.marks: dict[bytes, bytes | None] = {b"": b""}
        # what the library's byte level makes of the letters below U+0100, in lower case
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        letters = {c: chr(c).lower() for c in range(256) if chr(c).isalpha()}
        self.letters = {c: "".join(x for x, _ in spell(low)) for c, low in letters.items()}

    def _marks(self, run: bytes) -> bytes | None:
        """Ids of a run of marks behind a word; None if the library doesn't
        give them apart from the word's."""
        if run not in self.marks:
            if len(self.marks) > MEMO_CHUNKS // 10:
                self.marks = {b"": b""}
            word = self.library.encode("a", add_special_tokens=False).ids
            both = self.library.encode("a" + run.decode(), add_special_tokens=False).ids
            n = len(word)
            self.marks[run] = struct.pack(f"<{len(both) - n}I", *both[n:]) if both[:n] == word else None
        return self.marks[run]

    def _ask(self, chunk: bytes) -> bytes:
        """Ids of a chunk.  A chunk of letters below U+0100 and marks behind
        them is a word, which goes straight to the library's model, and the
        marks."""
        if len(chunk) <= MEMO_BYTES and (found := _WORD.fullmatch(chunk)):
            word, run = found.groups()
            tail = self.marks[run] if run in self.marks else self._marks(run)
            if tail is not None:
                low = word.lower() if word.isascii() else word.decode().lower().encode()
                if low != chunk:  # met before, as a chunk of its own or in another case
                    return self.memo[low] + tail
                plain = low.decode() if low.isascii() else low.decode().translate(self.letters)
                own = [t.id for t in self.model.tokenize(plain)]
                return _PACK[len(own)](*own)
        return np.array(self.library.encode(chunk.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: Iterable[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text, without special tokens."""
        if not self.chunks:
            coded = self.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(x.ids, "<u4").tobytes() for x in coded]
        if len(self.memo) > MEMO_CHUNKS:
            self.memo = _Memo(self._ask)
        ids = self.memo.__getitem__
        return [b"".join(map(ids, t.split())) for t in texts]


def coder(path: str) -> ChunkCoder:
    """This worker's coder for a tokenizer file."""
    if path not in _coders:
        _coders[path] = ChunkCoder(path)
    return _coders[path]


def text_bytes(data: np.ndarray, borders: np.ndarray) -> list[bytes]:
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]
