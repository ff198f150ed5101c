"""Near-duplicate documents by fast similarity sketching.

A document is its set of distinct word shingles.  The sketch of a set has
``BANDS * ROWS`` coordinates.  In round i every element is hashed anew, to a
value and to a bin; a bin that no earlier round filled takes the smallest
value placed in it.  The first t rounds place elements at random, round t + i
sends every element to bin i, so after 2t rounds at most every coordinate is
filled, and a set of n elements needs about t log t / n rounds.  Coordinates
of two sets agree with probability equal to their Jaccard similarity and
their mean concentrates as that of independent MinHashes does.

Sketches are cut into bands; documents that agree in a band are candidates.
At similarity 0.8 a pair misses all 32 bands of 5 rows with probability
(1 - 0.8^5)^32 < 4e-6.  Candidates are confirmed on their full shingle sets.

Large groups cost neither all pairs nor a large task.  Documents with equal
sets form one class, a numbered node: classes, not ids, are linked, so texts
that share a doc_id are judged each.  Then, per bucket of a
band, (1) each member is checked against the bucket's smallest id, a star;
(2) links give components; (3) a bucket whose members are now in several
components is finished: members outside the bucket's largest component meet
all members of other components, each pair in the first bucket it shares.
Before their sets are compared, pairs are refuted by a longer sketch of one bit
a coordinate: two sets of similarity 0.8 agree in nine bits of ten, and the
sketch's concentration bounds the chance to fall ``SIGMAS`` standard deviations
below that by 3e-7.  After that every pair that shares a bucket is linked,
connected or refuted; no bucket is capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelworks.llm.components import components
from funnelworks.llm.storage import broadcast_if_small, stored
from funnelworks.llm.words import NOT_SPACE, U, find_words, mix64, shingles, slices

BANDS, ROWS = 32, 5
#: Coordinates of the one-bit sketch, and how far below its mean a pair is refuted.
BITS, SIGMAS = 4096, 5
_EMPTY = U(0xFFFFFFFFFFFFFFFF)


def _seed(i: int) -> U:
    return U((0x9E3779B97F4A7C15 * (2 * i + 1)) & 0xFFFFFFFFFFFFFFFF)


def fast_similarity_sketch(elements: np.ndarray, borders: np.ndarray, t: int) -> np.ndarray:
    """(sets, t) sketches of the sets ``elements[borders[i]:borders[i + 1]]``;
    the coordinates of an empty set stay unfilled."""
    n = len(borders) - 1
    sizes = np.diff(borders)
    out = np.full(n * t, _EMPTY)
    empty = np.where(sizes > 0, t, 0)  # bins yet to fill
    e, text_no = elements, np.repeat(np.arange(n), sizes)
    for i in range(2 * t):
        if not len(e):
            break
        h = mix64(e ^ _seed(i))
        place = ((h >> U(32)) * U(t) >> U(32)).astype(np.int64) if i < t else i - t
        at = text_no * t + place
        open_ = out[at] == _EMPTY
        at = at[open_]
        np.minimum.at(out, at, h[open_])
        new = np.zeros(len(out), bool) if len(at) > len(out) // 4 else None
        if new is not None:
            new[at] = True
            empty -= new.reshape(n, t).sum(1)
        else:
            empty -= np.bincount(np.unique(at) // t, minlength=n)
        more = empty[text_no] > 0
        if not more.all():
            e, text_no = e[more], text_no[more]
    return out.reshape(n, t)


def _band_keys(sketch: np.ndarray) -> np.ndarray:
    out = np.empty((len(sketch), BANDS), U)
    for b in range(BANDS):
        x = np.full(len(sketch), _seed(1000 + b))
        for r in range(ROWS):
            x = mix64(x * U(0xA0761D6478BD642F) + sketch[:, b * ROWS + r])
        out[:, b] = x
    return out.view(np.int64)


def _sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values, out=total[1:])
    return (total[borders[1:]] - total[borders[:-1]]).view(np.int64)


def _signatures(k: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, borders in slices(batch.column(1), 1 << 20):
                sets, at = shingles(find_words(data, borders, NOT_SPACE), k)
                keys = _band_keys(fast_similarity_sketch(sets, at, BANDS * ROWS))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(lo, hi - lo) for c in (0, 2, 3)),
                        pa.array(np.diff(at), pa.int64()),
                        pa.array(_sums(mix64(sets ^ _seed(2001)), at)),
                        pa.array(_sums(mix64(sets ^ _seed(2002)), at)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, (hi - lo + 1) * BANDS, BANDS), pa.int32()), pa.array(keys.ravel())
                        ),
                    ],
                    ["doc_id", "t1", "t2", "n", "f1", "f2", "bands"],
                )

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, borders in slices(batch.column(1)):
                sets, at = shingles(find_words(data, borders, NOT_SPACE), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(np.diff(at), pa.int64()),
                        pa.array(_sums(mix64(sets ^ _seed(2001)), at)),
                        pa.array(_sums(mix64(sets ^ _seed(2002)), at)),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(sets.view(np.int64))),
                    ],
                    ["doc_id", "n", "f1", "f2", "elements"],
                )

    return run


def _bits(batches):
    """(id, bits): the lowest bits of a sketch of BITS coordinates."""
    for batch in batches:
        sets = batch.column(1)
        for lo in range(0, len(batch), 200):
            part = sets.slice(lo, 200)
            at = part.offsets.to_numpy().astype(np.int64)
            flat = part.values.to_numpy()[at[0] : at[-1]].view(U)
            odd = (fast_similarity_sketch(flat, at - at[0], BITS) & U(1)).astype(np.uint8)
            words = np.packbits(odd, axis=1).view(np.int64)
            ends = pa.array(np.arange(0, (len(part) + 1) * words.shape[1], words.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 200), pa.ListArray.from_arrays(ends, pa.array(words.ravel()))], ["id", "bits"])


def _may_link(one: str, two: str, percent: int) -> Column:
    """Whether two one-bit sketches agree as those of linked sets do."""
    agree = (1 + percent / 100) / 2
    least = agree - SIGMAS * (agree * (1 - agree) / BITS) ** 0.5
    differ = [F.bit_count(F.col(one)[i].bitwiseXOR(F.col(two)[i])) for i in range(BITS // 64)]
    return sum(differ[1:], differ[0]) <= int((1 - least) * BITS) + 1


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (a, b), those whose full sets have 100 |A n B| >= percent |A u B|."""
    one = sets.select(F.col("id").alias("b"), F.col("elements").alias("eb"))
    two = sets.select(F.col("id").alias("a"), F.col("elements").alias("ea"))
    joined = pairs.join(one, "b").join(two, "a")
    shared = F.size(F.array_intersect("ea", "eb")).cast("long")
    total = F.size("ea").cast("long") + F.size("eb").cast("long")
    return joined.select("a", "b", shared.alias("s"), total.alias("t")).where(
        F.col("s") * 100 >= (F.col("t") - F.col("s")) * percent
    ).select("a", "b")


def _judged(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """For each row of ``docs``: doc_id, t1 and t2 (hashes of the text), n
    (shingles), component_id, and whether its set is that of the component's
    smallest doc_id (``head``; one set, if several share that id)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    hashes = [F.xxhash64(F.lit(seed), F.col("text")).alias(name) for seed, name in ((1, "t1"), (2, "t2"))]
    marks = stored(
        texts.select("doc_id", "text", *hashes).mapInArrow(
            _signatures(shingle), "doc_id long, t1 long, t2 long, n long, f1 long, f2 long, bands array<long>"
        ),
        "near-marks",
    )
    alive = marks.where("n > 0 and doc_id is not null")
    classes = alive.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep")).withColumn("id", F.monotonically_increasing_id())
    classes = stored(classes, "near-classes")
    # one row of bands a class: that of its representative
    heads = classes.select(F.col("rep").alias("doc_id"), "n", "f1", "f2", "id")
    reps = alive.join(heads, ["doc_id", "n", "f1", "f2"]).select("id", "doc_id", "n", "f1", "f2", "bands").dropDuplicates(["id"])
    banded = reps.select("id", "n", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("members"))
    buckets = stored(buckets.where("members > 1").select("bucket", "head"), "near-buckets")
    members = stored(banded.join(broadcast_if_small(buckets), "bucket"), "near-members")

    ids = stored(members.select("id").distinct(), "near-ids")
    wanted = stored(heads.join(ids, "id", "left_semi"), "near-wanted")
    named = broadcast_if_small(wanted.select("doc_id").distinct())
    chosen = texts.join(named, "doc_id", "left_semi").mapInArrow(_sets(shingle), "doc_id long, n long, f1 long, f2 long, elements array<long>")
    chosen = chosen.join(broadcast_if_small(wanted), ["doc_id", "n", "f1", "f2"])
    sets = stored(chosen.select("id", "elements").dropDuplicates(["id"]), "near-sets")

    sizes = members.select("id", "n").distinct()
    star = members.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b"), "n").distinct()
    star = star.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a")
    near = (F.least("n", "na") * 100 >= F.greatest("n", "na") * percent)
    links = stored(_links(star.where(near).select("a", "b"), sets, percent), "near-links")

    labels = stored(components(links), "near-components")
    placed = stored(
        members.join(labels, members["id"] == labels["node"], "left").select(
            "bucket", "id", "n", F.coalesce("component", "id").alias("component")
        ),
        "near-placed",
    )
    split = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"))
    split = split.groupBy("bucket").agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
    split = stored(split.where("parts > 1").select("bucket", "main"), "near-split")
    if not split.isEmpty():
        rest = stored(placed.join(broadcast_if_small(split), "bucket"), "near-rest")
        ids = rest.select("id").distinct()
        bits = sets.join(ids, "id", "left_semi").mapInArrow(_bits, "id long, bits array<long>")
        bands = reps.select("id", "bands").join(ids, "id", "left_semi")
        rest = rest.join(stored(bits.join(bands, "id"), "near-bits"), "id")
        strays = rest.where("component <> main").select(
            "bucket", *(F.col(c).alias(f"x_{c}") for c in ("id", "n", "component", "bits", "bands"))
        )
        pairs = rest.join(
            strays.withColumnRenamed("bucket", "x_bucket"),
            (F.col("bucket") == F.col("x_bucket"))
            & (F.col("component") != F.col("x_component"))
            & (F.least("n", "x_n") * 100 >= F.greatest("n", "x_n") * percent)
            & _may_link("bits", "x_bits", percent)
            & (F.get(F.array_intersect("bands", "x_bands"), F.lit(0)) == F.col("bucket")),
        )
        pairs = pairs.select(F.least("id", "x_id").alias("a"), F.greatest("id", "x_id").alias("b")).distinct()
        more = stored(_links(pairs, sets, percent), "near-more")
        if not more.isEmpty():
            known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))  # stars already
            labels = stored(components(known.unionByName(more)), "near-components")

    # each component is named by its smallest doc_id; of several sets under that id, the one of smallest fingerprint stays
    top = F.struct("rep", "n", "f1", "f2")
    linked = classes.join(labels, classes["id"] == labels["node"])
    tops = stored(linked.groupBy("component").agg(F.min(top).alias("top")), "near-tops")
    grouped = classes.join(labels, classes["id"] == labels["node"], "left").join(tops, "component", "left")
    grouped = grouped.select(
        F.col("n").alias("cn"), F.col("f1").alias("c1"), F.col("f2").alias("c2"),
        F.coalesce("top.rep", "rep").alias("component"), F.coalesce(F.col("top") == top, F.lit(True)).alias("head"),
    )
    rows = marks.join(
        grouped,
        (F.col("n") == F.col("cn")) & (F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c2")) & F.col("doc_id").isNotNull(),
        "left",
    )
    own = F.coalesce("component", "doc_id").alias("component_id")
    return rows.select("doc_id", "t1", "t2", "n", own, F.coalesce("head", F.lit(True)).alias("head"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (needs doc_id, text; other columns are not
    read): doc_id, n_shingles, component_id, kept.

    Words are runs of other than ASCII white space, A-Z lower-cased; the set
    of a text is its distinct runs of ``shingle`` words, or its whole word
    sequence if shorter.  Documents with 100 |A n B| >= ``percent`` |A u B|
    are linked; component_id is the smallest doc_id reachable.  Null or empty
    texts have an empty set and are their own component.  A null doc_id is in
    no group: component_id null, kept.  A repeated row has the component of
    its text; texts under one doc_id are judged each by its own.  Empty table:
    no rows.
    """
    return _judged(docs, shingle, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def drop_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one text of each group, that of the smallest doc_id; all
    columns kept.  Rows go by doc_id and text, so another text under the id of
    a dropped one stays.  Rows that repeat id and set of a kept one stay."""
    gone = _judged(docs, shingle, percent).where(~(F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("head")))
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("t1").alias("__t1"), F.col("t2").alias("__t2")).distinct()
    gone = broadcast_if_small(stored(gone, "near-gone"))
    text = docs["text"]
    same = (F.xxhash64(F.lit(1), text) == gone["__t1"]) & (F.xxhash64(F.lit(2), text) == gone["__t2"])
    return docs.join(gone, (docs["doc_id"] == gone["__id"]) & same, "left_anti")
