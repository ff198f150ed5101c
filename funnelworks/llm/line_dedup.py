"""Lines repeated over documents, by a sharded minimal perfect hash.

1. Distinct line hashes of each document; how many documents hold each, and
   the largest of them.  Both are hash aggregates with partial sums, so a line
   that a third of all documents hold has no task of its own.
2. Lines of enough documents are dealt into shards by hash.  Each shard gets a
   minimal perfect hash and, by slot, arrays of fingerprints, counts and
   largest documents, in one file of the shared folder.  Other lines never
   decide anything and are left out: the index grows with the repeated lines
   alone.
3. Documents probe the arrays, instead of being joined with lines: a task
   loads the shards it needs, up to a bound of bytes at once, and compares
   fingerprints, so a line that isn't indexed has no match.

A line's identity is a pair of 64-bit hashes: place and fingerprint.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelworks.llm import perfect_hash
from funnelworks.llm.perfect_hash import PerfectHash
from funnelworks.llm.storage import open_in, open_out, scratch_path, stored
from funnelworks.llm.words import NOT_SPACE, U, mix64, slices

#: Keys of a shard, about 30 bytes each; bytes of shards that a worker keeps.
SHARD_KEYS, CACHE_BYTES = 1 << 20, 128 << 20
#: Text bytes hashed at once (one longer line is hashed alone).
WINDOW = 1 << 18
_shards: OrderedDict[str, tuple[int, PerfectHash, list[np.ndarray]]] = OrderedDict()

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_STEPS = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_VALUES = np.random.default_rng(20240911).integers(1, 1 << 63, (2, 256), dtype=np.uint64) * U(2) + U(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        full = np.full(max(n, WINDOW + 1), U(base))
        full[0] = 1
        _powers[base] = np.cumprod(full)
    return _powers[base][:n]


def text_lines(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of all lines of the texts, cut at line feeds; an empty
    text has one empty line."""
    feeds = np.flatnonzero(data == 10)
    n_lines = 1 + np.diff(np.searchsorted(feeds, borders))
    start = np.sort(np.concatenate((borders[:-1], feeds + 1)), kind="stable")
    end = np.sort(np.concatenate((feeds, borders[1:])), kind="stable")
    return np.repeat(np.arange(len(borders) - 1), n_lines), start, end


def line_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines, by number, whose key has at least ``min_chars`` code points, and
    the pairs of hashes (n x 2) of their keys: white space stripped at both
    ends, A-Z lower-cased."""
    solid = np.flatnonzero(NOT_SPACE[data])
    first, last = np.searchsorted(solid, start), np.searchsorted(solid, end) - 1
    some = np.flatnonzero(first <= last)
    start, end = solid[first[some]], solid[last[some]] + 1
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    long = chars[end] - chars[start] >= min_chars
    some, start, end = some[long], start[long], end[long]
    out = np.zeros((len(some), 2), U)
    lo = 0
    while lo < len(some):
        hi = max(int(np.searchsorted(end, start[lo] + WINDOW, "right")), lo + 1)
        base, size = start[lo], int(end[hi - 1] - start[lo])
        folded, a, z = _FOLDED[data[base : base + size]], start[lo:hi] - base, end[lo:hi] - base
        for i, (step, values) in enumerate(zip(_STEPS, _VALUES, strict=True)):
            sums = np.zeros(size + 1, U)
            np.cumsum(values[folded] * _power(step, size), out=sums[1:])
            out[lo:hi, i] = mix64((sums[z] - sums[a]) * _power(pow(step, -1, 1 << 64), size)[a] + (z - a).astype(U))
        lo = hi
    return some, out


def _held(min_chars: int):
    """(doc_id, h1, h2), each line once a text."""

    def run(batches):
        for batch in batches:
            for lo, hi, data, borders in slices(batch.column(1)):
                row, start, end = text_lines(data, borders)
                line, hashes = line_hashes(data, start, end, min_chars)
                row, (h1, h2) = row[line], hashes.T
                order = np.lexsort((h2, h1, row))
                row, h1, h2 = row[order], h1[order], h2[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                columns = [batch.column(0).slice(lo, hi - lo).take(pa.array(row[new])), *(pa.array(h[new].view(np.int64)) for h in (h1, h2))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h1", "h2"])

    return run


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(h1, h2, n_docs, keeper) of lines that at least ``min_docs`` documents hold."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = rows.mapInArrow(_held(min_chars), "doc_id long, h1 long, h2 long")
    counted = held.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
    return counted.where(F.col("n_docs") >= min_docs)


def _shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}"


def _build(folder: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h1", "h2"])  # the same bytes whenever the task is run again
        h1, h2 = (rows[c].to_numpy(np.int64).view(U) for c in ("h1", "h2"))
        index = PerfectHash.build(h1, h2)
        order = np.argsort(index.slots(h1, h2))
        shard = int(rows["shard"].iloc[0])
        columns = [h2[order], *(rows[c].to_numpy(np.int64)[order] for c in ("n_docs", "keeper"))]
        with open_out(_shard_path(folder, shard)) as out:
            out.write(perfect_hash.dump(index, columns))
        return pd.DataFrame({"shard": [shard], "n_keys": [len(rows)]})

    return run


def write_index(lines: DataFrame) -> tuple[str, int]:
    """Index files of ``repeated_lines``: their folder and number of shards."""
    lines = stored(lines, "repeated-lines")
    shards = -(-lines.count() // SHARD_KEYS)
    folder = scratch_path(lines.sparkSession, "line-index")
    if shards:
        dealt = lines.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
        stored(dealt.groupBy("shard").applyInPandas(_build(folder), "shard int, n_keys long"), "line-shards")
    return folder, shards


def _shard(path: str) -> tuple[PerfectHash, list[np.ndarray]]:
    """A shard, from this worker's cache or the shared folder."""
    if path in _shards:
        _shards.move_to_end(path)
    else:
        with open_in(path) as f:
            data = f.read()
        _shards[path] = (len(data), *perfect_hash.load(data, 3))
        while len(_shards) > 1 and sum(s[0] for s in _shards.values()) > CACHE_BYTES:
            _shards.popitem(last=False)
    return _shards[path][1:]


def probe(folder: str, shards: int, doc: np.ndarray, no_doc: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which lines are in the index with another keeper than their document."""
    drop = np.zeros(len(h1), bool)
    if not shards:
        return drop
    own = (h1.view(np.int64) % shards).astype(np.int64)
    order = np.argsort(own, kind="stable")
    cuts = np.searchsorted(own[order], np.arange(shards + 1))
    for shard in np.flatnonzero(np.diff(cuts)).tolist():
        at = order[cuts[shard] : cuts[shard + 1]]
        index, (prints, _, keeper) = _shard(_shard_path(folder, shard))
        slot = index.slots(h1[at], h2[at])
        known = (slot >= 0) & (prints[slot] == h2[at])
        at, slot = at[known], slot[known]
        drop[at] = no_doc[at] | (keeper[slot].view(np.int64) != doc[at])
    return drop


def _without(folder: str, shards: int, min_chars: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, borders in slices(batch.column(1)):
                row, start, end = text_lines(data, borders)
                line, hashes = line_hashes(data, start, end, min_chars)
                doc = batch.column(0).slice(lo, hi - lo)
                ids, none = (x.to_numpy(zero_copy_only=False) for x in (doc.fill_null(0), doc.is_null()))
                at = row[line]
                drop = np.zeros(len(row), bool)
                drop[line] = probe(folder, shards, ids[at], none[at], hashes[:, 0].copy(), hashes[:, 1].copy())
                whole, cuts = data.tobytes(), borders.tolist()
                texts = [whole[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                n_dropped = np.bincount(row[drop], minlength=hi - lo)
                first = np.searchsorted(row, np.arange(hi - lo + 1))
                for i in np.flatnonzero(n_dropped).tolist():
                    stay = first[i] + np.flatnonzero(~drop[first[i] : first[i + 1]])
                    texts[i] = b"\n".join([whole[a:z] for a, z in zip(start[stay].tolist(), end[stay].tolist(), strict=True)])
                columns = [doc, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(np.diff(first)), pa.array(n_dropped)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_lines", "n_dropped"])

    return run


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per row of ``docs`` (needs doc_id, text; other columns are not
    read): doc_id, text (lines that stay, joined by line feeds), n_lines
    (before dropping), n_dropped.

    A line's key is the line without ASCII white space at both ends, A-Z
    lower-cased.  Keys of at least ``min_chars`` code points that at least
    ``min_docs`` different doc_ids hold lose all their lines but those of the
    largest doc_id.  Null or empty text: one empty line.  Rows of one doc_id
    are one document; rows with a null doc_id count for no key and lose such
    lines.  Empty table: no rows.
    """
    folder, shards = write_index(repeated_lines(docs, min_chars, min_docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_without(folder, shards, min_chars), "doc_id long, text string, n_lines long, n_dropped long")
