"""Documents into sequences of fixed capacity by minimum bin slack.

A document longer than the capacity gives whole windows, each a sequence; what
is left over is one remainder below the capacity.  Only the number of
remainders of each length matters to the packing, so the plan is made from
that histogram, which has fewer rows than the capacity has tokens however
large the corpus is.  The plan takes the longest remainder left, and a
subset-sum program over the multiset of the other lengths, one bit per
reachable fill, finds the fill closest to the capacity; backtracking gives how
many of each length.  The same filling is then repeated as often as the
counts allow, so a few thousand fillings cover any number of rows.  Slack that
no multiset fills is closed by cutting a remainder; its tail goes back to the
others.  The last, partial window is cut at powers of two, which need no
padding.

A remainder finds its place by its rank among those of its length: the plan
maps ranges of ranks to runs of sequences.  Ranks come from counts of each
task and a running sum over tasks, so a length that a third of all documents
share is never one group.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelworks.llm.storage import broadcast_if_small, scratch_path
from funnelworks.llm.tokens import coder, text_bytes
from funnelworks.llm.words import slices


@dataclass
class Run:
    """Remainders of one length with ranks from ``first`` on: ``each`` of them
    in every one of ``windows`` sequences, the k-th at ``offset`` + k * take.
    Only their first ``take`` ids, if cut; the tails then are the remainders
    of length - take with ranks from ``tail`` on."""

    first: int
    windows: int
    each: int
    sequence: int
    offset: int
    take: int
    tail: int = -1


@dataclass
class Plan:
    capacity: int
    runs: dict[int, list[Run]] = field(default_factory=dict)
    sequences: int = 0

    def place(self, length: int, rank: int):
        """(start in the remainder, length, sequence, offset) of its pieces."""
        start = 0
        while True:
            runs = self.runs[length]
            run = runs[bisect_right(runs, rank, key=lambda r: r.first) - 1]
            k, j = divmod(rank - run.first, run.each)
            yield start, run.take, run.sequence + k, run.offset + j * run.take
            if run.tail < 0:
                return
            start, length, rank = start + run.take, length - run.take, run.tail + k


def fill(room: int, counts: dict[int, int]) -> dict[int, int]:
    """How many of each length fill ``room`` best, of the counted multiset:
    bitset subset sums, length by length from the longest, ended as soon as
    the room can be filled exactly; then backtracking."""
    mask = (1 << (room + 1)) - 1
    layers: list[tuple[int, int, int]] = []  # length, copies in this layer, reachable before it
    reach = 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        copies, step = min(counts[length], room // length), 1
        while copies:
            step = min(step, copies)  # copies in binary portions
            layers.append((length, step, reach))
            reach |= (reach << (length * step)) & mask
            copies -= step
            step *= 2
        if reach >> room & 1:
            break
    left = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, step, before in reversed(layers):
        if not before >> left & 1:
            used[length] = used.get(length, 0) + step
            left -= length * step
    return used


def make_plan(histogram: dict[int, int], capacity: int) -> Plan:
    plan = Plan(capacity)
    left = {x: n for x, n in histogram.items() if n}
    given = dict.fromkeys(left, 0)  # ranks used so far
    total = dict(left)

    def take(length: int, windows: int, each: int, offset: int, head: int) -> None:
        tail = -1
        if head < length:
            rest = length - head
            tail = total.get(rest, 0)
            total[rest] = tail + windows
            left[rest] = left.get(rest, 0) + windows
            given.setdefault(rest, 0)
        plan.runs.setdefault(length, []).append(Run(given[length], windows, each, plan.sequences, offset, head, tail))
        given[length] += windows * each
        left[length] -= windows * each
        if not left[length]:
            del left[length]

    while left and sum(x * n for x, n in left.items()) >= capacity:
        longest = max(left)
        others = dict(left)
        others[longest] -= 1
        used = fill(capacity - longest, {x: n for x, n in others.items() if n})
        used[longest] = used.get(longest, 0) + 1
        slack = capacity - sum(x * n for x, n in used.items())
        cut = 0
        if slack:  # the shortest remainder that is longer than the slack; there is one, as any shorter would have been used
            cut = min(x for x, n in left.items() if x > slack and n > used.get(x, 0))
        windows = min(left[x] // (n + (x == cut)) for x, n in used.items())
        if cut:
            windows = min(windows, left[cut] // (used.get(cut, 0) + 1))
        offset = 0
        for x, n in used.items():
            take(x, windows, n, offset, x)
            offset += x * n
        if cut:
            take(cut, windows, 1, offset, slack)
        plan.sequences += windows
    rest = sum(x * n for x, n in left.items())
    for power in reversed(range(rest.bit_length())):
        size = 1 << power
        if rest & size:
            offset = 0
            while offset < size:
                x = max(left)
                head = min(x, size - offset)
                take(x, 1, 1, offset, head)
                offset += head
            plan.sequences += 1
    return plan


def _pieces(path: str, end: int, capacity: int):
    """Task: whole windows and remainders of its documents; a remainder has
    its rank among the task's remainders of that length."""

    def run(batches):
        part = TaskContext.get().partitionId()
        tail = np.array([end], "<u4").tobytes()
        ranks: dict[int, int] = {}
        no = 0
        for batch in batches:
            for lo, hi, data, borders in slices(batch.column(1)):
                docs = batch.column(0).slice(lo, hi - lo).to_pylist()
                rows = []
                for doc, ids in zip(docs, coder(path).encode(text_bytes(data, borders)), strict=True):
                    ids += tail
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        length = min(capacity, n - start)
                        rank = ranks.get(length, 0)
                        ranks[length] = rank + 1
                        rows.append((part, no, doc, start, length, n, rank, ids[4 * start : 4 * (start + length)]))
                        no += 1
                yield _batch(rows, "part no doc_id start length doc_tokens rank ids")

    return run


def _batch(rows: list[tuple], names: str) -> pa.RecordBatch:
    names = names.split()
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    kind = {"ids": pa.binary(), "part": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(c, kind.get(n, pa.int64())) for c, n in zip(columns, names, strict=True)], names)


def _place(plan):
    def run(batches):
        p = plan.value
        for batch in batches:
            for at in range(0, len(batch), 500):
                rows = []
                for part, no, doc, start, length, n, rank, ids, base in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    if length == p.capacity:  # a sequence of its own: odd numbers
                        rows.append((doc, start, length, n, 2 * ((part << 38) + no) + 1, 0, ids))
                        continue
                    for a, size, sequence, offset in p.place(length, base + rank):
                        rows.append((doc, start + a, size, n, 2 * sequence, offset, ids[4 * a : 4 * (a + size)]))
                yield _batch(rows, "doc_id start length doc_tokens sequence_id offset ids")

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 1) -> DataFrame:
    """Pieces of all documents (needs doc_id, text; other columns are not
    read) in sequences of at most ``capacity`` ids: doc_id, start, length,
    doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    Every id of a document, with its ``end`` id, is in exactly one piece.  A
    sequence holds ``capacity`` ids or, for at most one window's worth in all,
    a smaller power of two.  Null or empty text: the end id alone.  Null
    doc_ids are carried; repeated rows are packed each.  Empty table: no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "part int, no long, doc_id long, start long, length long, doc_tokens long, rank long, ids binary"
    path = scratch_path(spark, "pieces")
    rows.mapInArrow(_pieces(tokenizer, end, capacity), schema).write.option("compression", "zstd").parquet(path)
    pieces = spark.read.schema(schema).parquet(path)

    counts = pieces.where(F.col("length") < capacity).groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    where = scratch_path(spark, "ranks")
    counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).write.parquet(where)
    counts = spark.read.parquet(where)
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # a row a length
    plan = spark.sparkContext.broadcast(make_plan(histogram, capacity))
    placed = pieces.join(broadcast_if_small(counts.drop("n")), ["part", "length"], "left").select(
        "part", "no", "doc_id", "start", "length", "doc_tokens", "rank", "ids", "base"
    )
    out = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return placed.mapInArrow(_place(plan), out)
