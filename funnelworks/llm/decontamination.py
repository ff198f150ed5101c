"""Benchmark items inside documents: size-partitioned MinHash containment.

Item and document are sets of word shingles; an item is found if a document
holds at least ``percent`` of its shingles, however long the document.

Documents are partitioned by the power of two above their set size.  Class U
(at most U shingles) uses sketches of ``SPREAD * U`` bins: one hash of every
shingle, and the smallest hash of each bin.  An item is sketched once per
class with the same hash and bins; a shared shingle is the smallest of its bin
in both sketches with probability above 0.85, since a bin holds 0.3 shingles on
average.  An item is a candidate as soon as one bin agrees.  Items are
partitioned by size as well: the smaller the class, the more independent
hashes are used, so that an item at the threshold is missed with probability
below ``MISS``.  Candidates are verified by exact shingle containment.

Documents are read once per block of items; a block is a bounded number of
items and bytes and is all that is sent to the executors.  Nothing is
shuffled but the pairs found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelworks.llm.words import U, find_letters, folded, mix64, shingles, slices

SPREAD, MISS = 4, 1e-6
#: A block of items.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 16 << 20
_SCHEMA = "doc_id long, item_id long, n_item long, n_shared long"


def repetitions(size: int, percent: int) -> int:
    """Independent sketches for items of ``size`` shingles or more."""
    load = (1 + (100 - percent) / 100) / SPREAD  # shingles in a bin, document and item together
    alone = (1 - math.exp(-load)) / load  # chance of a shared shingle to be the smallest
    shared = max(1, -(-size * percent // 100))
    return max(1, math.ceil(math.log(MISS) / (shared * math.log(1 - alone))))


def bin_minima(sorted_hashes: np.ndarray, bins: int) -> np.ndarray:
    """The smallest hash of every bin that has one.  A bin is a range of
    hashes, so those are the first hashes of their bins in sorted order."""
    place = (sorted_hashes >> U(32)) * U(bins) >> U(32)
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1]
    return sorted_hashes[first]


class ItemIndex:
    """Sketches of a block of items for every class of documents."""

    def __init__(self, ids: list, sets: list[np.ndarray], percent: int):
        self.ids, self.sets, self.percent = ids, sets, percent
        sizes = np.array([len(s) for s in sets], np.int64)
        self.reps = np.array([repetitions(1 << (int(n).bit_length() - 1), percent) if n else 0 for n in sizes], np.int64)
        self.rounds = int(self.reps.max(initial=0))
        self._made: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def sketch(self, bins: int, rnd: int) -> tuple[np.ndarray, np.ndarray]:
        """Bin minima of the items that use round ``rnd``, sorted, with item numbers."""
        if (bins, rnd) not in self._made:
            values, items = [np.zeros(0, U)], [np.zeros(0, np.int64)]
            for i in np.flatnonzero(self.reps > rnd):
                own = bin_minima(np.sort(hashed(self.sets[i], rnd)), bins)
                values.append(own)
                items.append(np.full(len(own), i))
            values, items = np.concatenate(values), np.concatenate(items)
            order = np.argsort(values, kind="stable")
            self._made[bins, rnd] = values[order], items[order]
        return self._made[bins, rnd]

    def found(self, own: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item number, item size, shared) for a document's sorted set."""
        if not len(own):
            return
        bins = SPREAD << (len(own) - 1).bit_length()
        seen: set[int] = set()
        for rnd in range(self.rounds):
            values, items = self.sketch(bins, rnd)
            mine = bin_minima(np.sort(hashed(own, rnd)), bins)
            lo = np.searchsorted(values, mine, "left")
            hi = np.searchsorted(values, mine, "right")
            for a, b in zip(lo[lo < hi], hi[lo < hi], strict=True):
                seen.update(items[a:b].tolist())
        for i in sorted(seen):
            item = self.sets[i]
            at = np.minimum(np.searchsorted(own, item), len(own) - 1)
            shared = int((own[at] == item).sum())
            if shared * 100 >= len(item) * self.percent:
                yield i, len(item), shared


def hashed(elements: np.ndarray, rnd: int) -> np.ndarray:
    return mix64(elements ^ U((0x9E3779B97F4A7C15 * (2 * rnd + 1)) & 0xFFFFFFFFFFFFFFFF))


def _search(block, shingle: int, percent: int):
    def run(batches):
        index = ItemIndex(*block.value, percent)
        for batch in batches:
            for lo, _, data, borders in slices(folded(batch.column(1))):
                sets, at = shingles(find_letters(data, borders), shingle)
                out: list[tuple] = []
                for d in range(len(at) - 1):
                    own = sets[at[d] : at[d + 1]]
                    doc = None
                    for i, size, shared in index.found(own):
                        doc = batch.column(0)[lo + d].as_py() if doc is None else doc
                        out.append((doc, index.ids[i], size, shared))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "item_id", "n_item", "n_shared"]
                    )

    return run


def item_blocks(benchmark: DataFrame, shingle: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """The items that have shingles, with their sets, in bounded blocks."""
    rows: list = []
    size = 0

    def block():
        texts = pa.array([r["text"] or "" for r in rows], pa.string())
        ids, sets = [], []
        for lo, hi, data, borders in slices(folded(texts)):
            flat, at = shingles(find_letters(data, borders), shingle)
            for d in range(hi - lo):
                if at[d] < at[d + 1]:
                    ids.append(rows[lo + d]["item_id"])
                    sets.append(flat[at[d] : at[d + 1]])
        return ids, sets

    for row in benchmark.select("item_id", "text").toLocalIterator():
        rows.append(row)
        size += len(row["text"] or "")
        if len(rows) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield block()
            rows, size = [], 0
    if rows:
        yield block()


def contained_items(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Distinct (doc_id, item_id, n_item, n_shared): documents (doc_id, text)
    that hold at least ``percent`` of the n_item distinct shingles of a
    benchmark item (item_id, text); other columns are not read.

    Words are runs of Unicode letters, marks and digits of the composed,
    lower-cased text, so case, accents put together from marks, punctuation,
    typographic marks and any kind of space don't hide a passage; in scripts
    without spaces each character is a word.  A text of fewer than ``shingle`` words is one shingle, its
    whole sequence.  Texts without words, null texts included, match
    nothing.  Null ids are carried as null; repeated rows give one row.
    Without documents or items: no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    found = None
    for ids, sets in item_blocks(items, shingle):
        block = spark.sparkContext.broadcast((ids, sets))
        part = texts.mapInArrow(_search(block, shingle, percent), _SCHEMA)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], _SCHEMA) if found is None else found.distinct()


def _clean(block, shingle: int, percent: int, column: int):
    def run(batches):
        index = ItemIndex(*block.value, percent)
        for batch in batches:
            clean = []
            for _, _, data, borders in slices(folded(batch.column(column))):
                sets, at = shingles(find_letters(data, borders), shingle)
                clean += [next(index.found(sets[at[d] : at[d + 1]]), None) is None for d in range(len(at) - 1)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns
    kept.  Each row is judged by its own text, in place, whatever its doc_id.
    Documents are read once; a block of items sees what the ones before left."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    column, schema = docs.columns.index("text"), docs.schema
    for ids, sets in item_blocks(items, shingle):
        block = docs.sparkSession.sparkContext.broadcast((ids, sets))
        docs = docs.mapInArrow(_clean(block, shingle, percent, column), schema)
    return docs
