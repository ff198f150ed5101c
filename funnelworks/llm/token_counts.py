"""Token counts of whole texts, counted once per distinct pre-token.

A pre-token is a run of white space with the characters up to the next (or
the white space that ends a text).  A byte-level tokenizer never builds a
token over a border between a character and the white space after it, and
what it does between two such borders depends on nothing outside, so a text's
count is the sum of its pre-tokens' counts; special strings hold no white
space and fall inside one pre-token.

1. Distinct pre-tokens with their frequencies over all documents: summed in
   the tasks, then by an exchange.  2. The library counts the pieces of each
   once.  3. Per document, the frequencies of its pre-tokens meet those
   counts.  Pre-tokens that make up at least one in ``HOT`` of all
   occurrences, of which there can be no more than ``HOT``, are sent to the
   tasks, by hash, and summed there; (row, pre-token, frequency) rows of the
   others are joined by an exchange, which thus has no hot key.  No ids are
   kept or moved.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelworks.llm.storage import stored
from funnelworks.llm.words import U, pre_tokens, slices, texts_of

#: Bound on pre-tokens sent to the tasks, each as a hash and a count.
HOT = 1 << 21
#: Distinct pre-tokens of a task that are gathered before they are passed on.
GATHER = 1 << 20


def _distinct(batches):
    """(piece, n) of a task's texts, summed over up to GATHER entries."""
    have: list[tuple] = []  # hashes, counts, places in the strings; strings
    size = 0

    def merged():
        h = np.concatenate([x[0] for x in have])
        strings = pa.concat_arrays([x[2] for x in have])
        unique, first, group = np.unique(h, return_index=True, return_inverse=True)
        n = np.bincount(group, np.concatenate([x[1] for x in have])).astype(np.int64)
        return unique, n, strings.take(pa.array(first))

    for batch in batches:
        for _, _, data, borders in slices(batch.column(0), 4 << 20):
            w = pre_tokens(data, borders)
            unique, first, n = np.unique(w.hashes(), return_index=True, return_counts=True)
            have.append((unique, n, texts_of(data, w.start[first], w.end[first])))
            size += len(unique)
            if size > GATHER:
                have = [merged()]
                size = len(have[0][0])
                if size > GATHER // 2:
                    yield _pairs(have[0])
                    have, size = [], 0
    if have:
        yield _pairs(merged())


def _pairs(found: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([found[2], pa.array(found[1])], ["piece", "n"])


def _count(path: str):
    """Pieces of each pre-token by the library, and its hash."""

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        for batch in batches:
            coded = library.encode_batch_fast(batch.column(0).to_pylist(), add_special_tokens=False)
            hashes = [np.zeros(0, U)]
            for _, _, data, borders in slices(batch.column(0)):
                w = pre_tokens(data, borders)  # each is one, whole
                hashes.append(w.spans(borders[:-1], borders[1:]))
            extra = [pa.array([len(x) for x in coded], pa.int64()), pa.array(np.concatenate(hashes).view(np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], ["piece", "n", "pieces", "hash"])

    return run


def _meet(hot):
    """Per row: its size, the tokens of its hot pre-tokens, and its other
    pre-tokens with their frequencies."""

    def run(batches):
        hashes, pieces = hot.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, data, borders in slices(batch.column(1)):
                n = hi - lo
                w = pre_tokens(data, borders)
                h, text_no = w.hashes(), w.text_no
                at = np.minimum(np.searchsorted(hashes, h), max(len(hashes) - 1, 0))
                is_hot = hashes[at] == h if len(hashes) else np.zeros(len(h), bool)
                tokens = np.bincount(text_no[is_hot], pieces[at[is_hot]], n).astype(np.int64)
                cold = np.flatnonzero(~is_hot)
                order = cold[np.lexsort((h[cold], text_no[cold]))]
                new = np.ones(len(order), bool)
                new[1:] = (h[order][1:] != h[order][:-1]) | (text_no[order][1:] != text_no[order][:-1])
                first = order[new]
                times = np.diff(np.append(np.flatnonzero(new), len(order)))
                others = pa.StructArray.from_arrays([texts_of(data, w.start[first], w.end[first]), pa.array(times)], ["piece", "times"])
                ends = np.searchsorted(text_no[first], np.arange(n + 1), "left").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)),
                        batch.column(0).slice(lo, n),
                        pa.array(np.diff(borders)),
                        pa.array(tokens),
                        pa.ListArray.from_arrays(pa.array(ends), others),
                    ],
                    ["row", "doc_id", "n_bytes", "hot", "others"],
                )
                row += n

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """One row per row of ``docs`` (needs doc_id, text; other columns are not
    read): doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``).

    ``tokenizer``: path of a byte-level .json file, the same on every
    executor.  No special tokens are added; special strings inside a text
    count as the library counts them.  Null or empty text: 0 bytes, 0 tokens.
    Null doc_ids are carried; each repeated row gives a row.  Empty table: no
    rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.select("text").mapInArrow(_distinct, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    known = stored(found.mapInArrow(_count(tokenizer), "piece string, n long, pieces long, hash long"), "pre-tokens")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") * HOT >= total
    table = known.where(is_hot).select("hash", "pieces").toArrow()
    hashes, pieces = (table.column(i).to_numpy() for i in range(2))
    order = np.argsort(hashes.view(np.uint64))
    hot = docs.sparkSession.sparkContext.broadcast((hashes.view(np.uint64)[order], pieces[order]))

    schema = "row long, doc_id long, n_bytes long, hot long, others array<struct<piece:string,times:long>>"
    met = rows.mapInArrow(_meet(hot), schema).select("row", "doc_id", "n_bytes", "hot", F.inline_outer("others"))
    # a row without other pre-tokens joins nothing, under a name of its own: no common null key
    met = met.withColumn("piece", F.coalesce("piece", F.concat(F.lit("\x00"), F.col("row").cast("string"))))
    cold = known.where(~is_hot).select("piece", "pieces")
    tokens = F.max("hot") + F.sum(F.coalesce(F.col("times") * F.col("pieces"), F.lit(0)))
    counted = met.join(cold, "piece", "left").groupBy("row", "doc_id", "n_bytes").agg(tokens.alias("n_tokens"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
