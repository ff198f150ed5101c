"""Token ids of documents in binary files, coded by ``rans``.

Documents are dealt into ranges of doc_id; each range is tokenised by one task
into a plain working file, whose symbol counts are merged to one frequency
table for the whole data set; each range is then coded into its final file
and the working file goes.  All steps move texts once and ids never.

A file: header (magic, table checksum), blocks, then a footer with the
documents (id, null flag, number of ids) and an index of blocks (offset,
bytes, ids before), and the footer's length and checksum.  ``table`` beside
the files has the shared frequencies.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelworks.llm import rans
from funnelworks.llm.storage import exists, open_in, open_out, remove, scratch_path, stored
from funnelworks.llm.tokens import coder, text_bytes
from funnelworks.llm.words import slices

_HEAD = struct.Struct("<8sII")  # magic, crc32 of the table, reserved
_TAIL = struct.Struct("<QI8s")  # footer bytes, its crc32, magic
_WORK = struct.Struct("<QQB")  # documents, ids, bytes an id
MAGIC = b"RANIDS01"
#: Tasks that add up the symbol counts of all files before the driver adds theirs.
MERGES = 8


@dataclass
class IdFiles:
    """A written data set: ``parts`` has a row (part, path, n_docs, n_tokens)
    a file, in ascending order of documents."""

    folder: str
    parts: DataFrame


def _tokenise(folder: str, path: str, end: int):
    """Task: its documents, already in order, into a working file; yields the
    file and its symbol counts."""

    def run(batches):
        part = TaskContext.get().partitionId()
        uri = f"{folder}/part-{part:06d}.work"
        counts = np.zeros(1 << 16, np.int64)
        n_docs = n_tokens = 0
        tail = np.array([end], "<u4").tobytes()
        with open_out(uri) as out, zstandard.ZstdCompressor(level=1).stream_writer(out, closefd=False) as work:
            for batch in batches:
                for lo, hi, data, borders in slices(batch.column(1)):
                    coded = [c + tail for c in coder(path).encode(text_bytes(data, borders))]
                    ids = np.frombuffer(b"".join(coded), "<u4")
                    doc = batch.column(0).slice(lo, hi - lo)
                    kind = "<u2" if ids.max() < 1 << 16 else "<u4"
                    work.write(_work_head(hi - lo, len(ids), np.dtype(kind).itemsize))
                    work.write(doc.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                    work.write(doc.is_null().to_numpy(zero_copy_only=False).astype("u1").tobytes())
                    work.write(np.array([len(c) // 4 for c in coded], "<i8").tobytes())
                    work.write(ids.astype(kind).tobytes())
                    more = np.bincount(ids, minlength=len(counts))
                    more[: len(counts)] += counts
                    counts = more
                    n_docs += hi - lo
                    n_tokens += len(ids)
        if not n_docs:
            remove(uri)
            return
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int32()),
                "work": [uri],
                "n_docs": [n_docs],
                "n_tokens": [n_tokens],
                "symbols": pa.array([used.tolist()], pa.list_(pa.int64())),
                "counts": pa.array([counts[used].tolist()], pa.list_(pa.int64())),
            }
        )

    return run


def _work_head(n: int, m: int, width: int) -> bytes:
    return _WORK.pack(n, m, width)


def _work_batches(uri: str):
    with open_in(uri) as raw, zstandard.ZstdDecompressor().stream_reader(raw, closefd=False) as work:
        while head := work.read(_WORK.size):
            n, m, width = _WORK.unpack(head)
            docs = np.frombuffer(work.read(8 * n), "<i8")
            nulls = np.frombuffer(work.read(n), "u1")
            lengths = np.frombuffer(work.read(8 * n), "<i8")
            yield docs, nulls, lengths, np.frombuffer(work.read(width * m), f"<u{width}")


def write_file(uri: str, batches, table: rans.Table, table_crc: int) -> None:
    """One file from batches (doc ids, null flags, lengths, ids)."""
    docs, nulls, lengths, index = [], [], [], []
    with open_out(uri) as out:
        out.write(_HEAD.pack(MAGIC, table_crc, 0))
        at, before = _HEAD.size, 0
        rest = np.zeros(0, "<u4")

        def put(ids: np.ndarray) -> None:
            nonlocal at, before
            block = rans.encode_block(ids, table)
            out.write(block)
            index.append((at, len(block), before))
            at += len(block)
            before += len(ids)

        for d, z, n, ids in batches:
            docs.append(d)
            nulls.append(z)
            lengths.append(n)
            rest = np.concatenate((rest, ids))
            whole = len(rest) // rans.BLOCK_IDS * rans.BLOCK_IDS
            for a in range(0, whole, rans.BLOCK_IDS):
                put(rest[a : a + rans.BLOCK_IDS])
            rest = rest[whole:]
        if len(rest):
            put(rest)
        footer = zlib.compress(
            struct.pack("<QQQ", sum(map(len, docs)), len(index), before)
            + b"".join(x.astype(k).tobytes() for xs, k in ((docs, "<i8"), (nulls, "u1"), (lengths, "<i8")) for x in xs)
            + np.array(index, "<u8").reshape(-1, 3).tobytes()
        )
        out.write(footer)
        out.write(_TAIL.pack(len(footer), zlib.crc32(footer), MAGIC))


class IdReader:
    """Documents and ids of a file."""

    def __init__(self, uri: str, table: rans.Table, table_crc: int):
        self.file, self.table = open_in(uri), table
        magic, crc, _ = _HEAD.unpack(self.file.read(_HEAD.size))
        if magic != MAGIC or crc != table_crc:
            raise ValueError(f"{uri}: not coded with this table")
        self.file.seek(self.file.size() - _TAIL.size)
        size, crc, magic = _TAIL.unpack(self.file.read(_TAIL.size))
        self.file.seek(self.file.size() - _TAIL.size - size)
        footer = self.file.read(size)
        if magic != MAGIC or zlib.crc32(footer) != crc:
            raise ValueError(f"{uri}: damaged footer")
        footer = zlib.decompress(footer)
        n, blocks, self.n_ids = struct.unpack_from("<QQQ", footer)
        self.docs = np.frombuffer(footer, "<i8", n, 24)
        self.nulls = np.frombuffer(footer, "u1", n, 24 + 8 * n)
        self.lengths = np.frombuffer(footer, "<i8", n, 24 + 9 * n)
        self.index = np.frombuffer(footer, "<u8", 3 * blocks, 24 + 17 * n).reshape(-1, 3).astype(np.int64)

    def block(self, i: int, first: int = 0, last: int | None = None) -> np.ndarray:
        self.file.seek(int(self.index[i, 0]))
        return rans.decode_block(self.file.read(int(self.index[i, 1])), self.table, first, last)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo .. hi - 1 of the file, from the blocks that hold them."""
        out = [np.zeros(0, "<u4")]
        i = int(np.searchsorted(self.index[:, 2], lo, "right")) - 1
        while lo < hi and i < len(self.index):
            base = int(self.index[i, 2])
            end = int(self.index[i + 1, 2]) if i + 1 < len(self.index) else self.n_ids
            out.append(self.block(i, lo - base, min(hi, end) - base))
            lo, i = end, i + 1
        return np.concatenate(out)

    def documents(self):
        """(doc id or None, first id's place in the file, ids) in order;
        holds one block and one document at a time."""
        ends = np.cumsum(self.lengths)
        have, base, block = np.zeros(0, "<u4"), 0, 0
        for doc, null, end, n in zip(self.docs.tolist(), self.nulls.tolist(), ends.tolist(), self.lengths.tolist(), strict=True):
            parts = [have]
            size = len(have)
            while base + size < end:
                parts.append(self.block(block))
                size += len(parts[-1])
                block += 1
            have = np.concatenate(parts) if len(parts) > 1 else have
            yield None if null else doc, end - n, have[:n]
            have, base = have[n:], end


def _table(folder: str) -> tuple[rans.Table, int]:
    with open_in(f"{folder}/table") as f:
        data = f.read()
    return rans.Table.load(data), zlib.crc32(data)


def _add_counts(batches) -> np.ndarray:
    total = np.zeros(1, np.int64)
    for batch in batches:
        symbols, counts = (batch.column(i).flatten().to_numpy() for i in range(2))
        if len(symbols):
            more = np.bincount(symbols, counts, minlength=len(total)).astype(np.int64)
            more[: len(total)] += total
            total = more
    return total


def _merged_counts(batches):
    total = _add_counts(batches)
    used = np.flatnonzero(total)
    kind = pa.list_(pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array([used], kind), pa.array([total[used]], kind)], ["symbols", "counts"])


def _code(folder: str):
    def run(batches):
        table, crc = _table(folder)
        for batch in batches:
            for part, work in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                uri = work.removesuffix(".work") + ".ids"
                if not exists(uri):  # there already if a lost task had come this far
                    write_file(uri, _work_batches(work), table, crc)
                if exists(work):
                    remove(work)
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [uri]})

    return run


def write_ids(docs: DataFrame, tokenizer: str, end: int = 1, folder: str | None = None) -> IdFiles:
    """Tokenise every whole text of ``docs`` (needs doc_id, text; other columns
    are not read), append ``end``, and write the ids in ascending doc_id
    order.

    Null or empty text: the end id alone.  Null doc_ids come first; repeated
    doc_ids follow each other, ordered by a hash of their texts.  Empty
    table: no file but the table.  ``tokenizer``: path of a .json file that
    drops white space, the same on every executor.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "ids")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "part int, work string, n_docs long, n_tokens long, symbols array<long>, counts array<long>"
    work = stored(rows.mapInArrow(_tokenise(folder, tokenizer, end), schema), "ids-work")
    merged = work.select("symbols", "counts").repartition(MERGES).mapInArrow(_merged_counts, "symbols array<long>, counts array<long>")
    counts = _add_counts(merged.toArrow().to_batches())  # MERGES rows at most, an entry a symbol of the vocabulary
    used = np.flatnonzero(counts)
    table = rans.scaled(used, counts[used])
    with open_out(f"{folder}/table") as f:
        f.write(table.dump())
    files = max(1, work.count())
    done = stored(
        work.select("part", "work").repartitionByRange(files, "part").mapInArrow(_code(folder), "part int, path string"), "ids-done"
    )
    return IdFiles(folder, done.join(work.select("part", "n_docs", "n_tokens"), "part"))


def _decode(folder: str):
    def run(batches):
        table, crc = _table(folder)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                size = 0
                for doc, start, ids in IdReader(path, table, crc).documents():
                    rows.append((doc, base + start, len(ids), ids.tobytes()))
                    size += len(ids)
                    if size > 1 << 20:
                        yield _documents(rows)
                        rows, size = [], 0
                yield _documents(rows)

    return run


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "start", "n_tokens", "ids"])


def read_ids(spark: SparkSession, written: IdFiles) -> DataFrame:
    """The files' documents: doc_id, start (ids of all documents before it),
    n_tokens, ids (little-endian unsigned 32-bit integers)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    parts = written.parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    parts = stored(parts.select("part", "path", "base"), "ids-parts")
    parts = parts.repartitionByRange(max(1, parts.count()), "part").select("path", "base")
    return parts.mapInArrow(_decode(written.folder), "doc_id long, start long, n_tokens long, ids binary")
