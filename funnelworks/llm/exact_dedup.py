"""Exact deduplication by a tree merge of sorted digest runs.

DataFrame operations only.  Every partition of the digest table gives one run:
its distinct digests in order, each with the smallest id and the number of rows
behind it.  In every round the runs whose numbers differ in the lowest
remaining digit (to base ``FAN_IN``) meet: the others move to the one with the
digit 0, as in a binomial tree with ``FAN_IN`` children a node, and are merged in
order of digest; of equal neighbours the smallest id and the sum of the rows
remain.  A merged run is written sorted, and the next round reads it.  The number
of rounds follows from the number of runs present: one more for every factor of
``FAN_IN``.

A run is spread over the cluster by (run, digest), so no task holds a whole one,
and each task holds its share in order.  A digest held by a third of all rows is
one row a run after the first aggregate, and at most ``FAN_IN`` rows meet for one
key in a round.  The answer goes back down the same way: the last run is joined
to the first ones, and those by (run, digest) to the documents, which deals
copies of one text over all runs instead of one task.

Equality is verified at every level by the whole key: SHA-256, the byte
length and an independent 64-bit hash of the normalised text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelworks.llm.storage import broadcast_if_small, stored

#: Runs merged into one in a round.
FAN_IN = 8
KEY = ["digest", "n_bytes", "second"]


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, run (the partition) and the key of each row's normalised text."""
    t = normalised(F.col("text"))
    return docs.select(F.col("doc_id"), t.alias("t")).select(
        "doc_id",
        F.spark_partition_id().alias("run"),
        F.sha2(F.col("t").cast("binary"), 256).alias("digest"),
        F.octet_length("t").cast("long").alias("n_bytes"),
        F.xxhash64("t").alias("second"),
    )


def first_runs(rows: DataFrame) -> DataFrame:
    """The distinct digests of each run, in order."""
    found = rows.groupBy("run", *KEY).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return found.sortWithinPartitions("run", *KEY)


def merge_runs(level: DataFrame, width: int) -> DataFrame:
    """One round: the runs of each ``width * FAN_IN`` numbers become one, in
    order.  Rows of equal (run, key) are neighbours there, at most ``FAN_IN`` of
    them; the first has the smallest id."""
    met = level.withColumn("run", F.col("run") - F.pmod("run", F.lit(width * FAN_IN)))
    order = F.col("keep_id").asc_nulls_last()
    equal = Window.partitionBy("run", *KEY).orderBy(order)
    merged = met.select(
        "run",
        *KEY,
        "keep_id",
        F.sum("group_size").over(equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("group_size"),
        F.row_number().over(equal).alias("place"),
    )
    return merged.where("place = 1").drop("place")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (needs doc_id, text; other columns are not
    read): doc_id, keep_id, group_size, kept, text_sha256.

    Null or empty text: an ordinary text of zero bytes.  Null doc_id: counts
    as larger than every id, so its keep_id is the group's smallest other id;
    null if the group has none, and then kept.  Repeated rows of one doc_id
    count each in group_size and are kept or dropped together.  Empty table:
    no rows.
    """
    rows = stored(digests(docs), "exact-digests")
    first = stored(first_runs(rows), "exact-runs")
    last = rows.agg(F.max("run")).first()[0] or 0  # the runs present are at most those up to it
    level, width = first, 1
    while width <= last:
        level = stored(merge_runs(level, width), "exact-merged")
        width *= FAN_IN
    top = level.drop("run")
    down = first.select("run", *KEY).join(top, KEY)
    return (
        rows.join(down, ["run", *KEY])
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row a distinct normalised text, all columns kept.
    Rows of one text that repeat the kept id are reduced to one.  The texts
    themselves are not shuffled while the list of dropped rows is of a size
    that may be broadcast; beyond that the join is dealt by key."""
    groups = stored(exact_groups(docs), "exact-groups")
    by = [F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")]
    sha = F.sha2(normalised(docs["text"]).cast("binary"), 256)

    def match(rows: DataFrame) -> Column:
        return docs["doc_id"].eqNullSafe(rows["__id"]) & (sha == rows["__sha"])

    gone = stored(groups.where(~F.col("kept")).select(*by).distinct(), "exact-gone")
    kept = docs.join(broadcast_if_small(gone, 160), match(gone), "left_anti")
    again = stored(groups.where("kept").select(*by).groupBy("__id", "__sha").count().where("count > 1"), "exact-again")
    if again.isEmpty():
        return kept
    once = broadcast_if_small(again.select("__id", "__sha"), 160)
    one = docs.join(once, match(once), "inner").dropDuplicates(["__id", "__sha"]).select(*docs.columns)
    return kept.join(once, match(once), "left_anti").unionByName(one)
