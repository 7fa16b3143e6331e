"""Exact deduplication by progressive refinement, in DataFrame functions.

Rows are grouped by the length of their text, rows of a shared length by a hash
of its first characters, and only rows that still share both have their whole
text hashed. The first two levels keep classes of a fixed number instead of
single groups: a class that holds two rows lets both pass, so nothing that has
a copy is lost, and what passes is told apart by SHA-256 of the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.frames import shuffle_partitions, stored

# Characters that the second level looks at.
PREFIX = 256
# Classes of lengths and of prefixes. Up to so many long numbers are broadcast.
CLASSES = 1 << 20
# A group above one part in so many of a shuffle partition's rows is not shuffled.
PARTS_PER_PARTITION = 8


def _whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _by_length(length: Column, classes: int) -> Column:
    return F.pmod(length, F.lit(classes))


def _by_prefix(length: Column, prefix: Column, classes: int) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(classes))


def _shared(rows: DataFrame, number: Column, name: str) -> DataFrame:
    """The classes with two rows or more; tasks count before the shuffle."""
    counted = rows.groupBy(number.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(counted.where("n > 1").select(name))


def _refined(docs: DataFrame, classes: int) -> DataFrame:
    """``id, text, digest`` of every row; the digest is NULL where no row can be equal."""
    text = _whole(F.col("text"))
    rows = docs.select(F.col("doc_id").alias("id"), text.alias("text"))
    length = F.octet_length("text").cast("long")
    prefix = F.xxhash64(F.substring("text", 1, PREFIX))
    first = stored(rows.select(length.alias("length"), prefix.alias("prefix")), "lengths")
    sizes = _shared(first, _by_length(F.col("length"), classes), "size_class")
    left = first.withColumn("size_class", _by_length(F.col("length"), classes)).join(sizes, "size_class")
    heads = _shared(left, _by_prefix(F.col("length"), F.col("prefix"), classes), "head_class")

    keyed = rows.withColumn("size_class", _by_length(length, classes))
    keyed = keyed.join(sizes.withColumn("same_size", F.lit(True)), "size_class", "left")
    # Only rows of a shared length have the hash of their prefix made.
    head = F.when(F.col("same_size"), _by_prefix(length, prefix, classes))
    keyed = keyed.withColumn("head_class", head)
    keyed = keyed.join(heads.withColumn("same_head", F.lit(True)), "head_class", "left")
    digest = F.when(F.col("same_head"), F.sha2("text", 256))
    return keyed.select("id", "text", digest.alias("digest"))


def _groups(rows: DataFrame) -> DataFrame:
    """``digest, keep_id, place, n`` of the texts that several rows have."""
    found = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.max(F.struct("id", "place")).alias("best"), F.count(F.lit(1)).alias("n")
    )
    found = found.where("n > 1").select("digest", F.col("best.id").alias("keep_id"), "best.place", "n")
    return stored(found, "copies")


def _matched(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Each row with the figures of its group.

    Groups of more than one part in ``parts`` of all copies are broadcast, so
    there are fewer than ``parts`` of them whatever the size of the data, and
    their rows are not gathered. Rows without a group are dealt out by a hash
    of their own.
    """
    parts = PARTS_PER_PARTITION * shuffle_partitions(rows.sparkSession)
    total = groups.agg(F.sum("n")).first()[0] or 0
    limit = -(-total // parts)
    figures = ("keep_id", "best_place", "n")
    groups = groups.withColumnRenamed("place", "best_place")
    hot = groups.where(F.col("n") > limit).select("digest", F.struct(*figures).alias("hot"))
    rows = rows.join(F.broadcast(hot), "digest", "left")
    alone = F.col("digest").isNull() | F.col("hot").isNotNull()
    rows = rows.withColumns({
        "key": F.when(~alone, F.col("digest")),
        "spread": F.when(alone, F.xxhash64("place")).otherwise(0),
    })
    cold = groups.where(F.col("n") <= limit).select(
        F.col("digest").alias("key"), F.lit(0).cast("long").alias("spread"), F.struct(*figures).alias("cold")
    )
    return rows.join(cold, ["key", "spread"], "left").withColumn("group", F.coalesce("hot", "cold"))


def copies(docs: DataFrame, with_digest: bool = False, classes: int = CLASSES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept`` of every row, from ``doc_id, text``.

    Rows are equal if their texts are, byte for byte; a null text is an empty
    one. The row with the largest ``doc_id`` of a group stays (``kept``), and
    exactly one row of every group does: of rows that share the largest id, or
    that are all without id, one is taken. A null id is below all others, so
    ``keep_id`` is null only where the whole group has none. Other columns are
    ignored, whatever their names; an empty table gives an empty one.

    With ``with_digest`` a column ``text_sha256`` holds the digest of every
    text, so that those which no row can equal are hashed too.

    The texts are read twice and never shuffled: once for lengths and prefixes
    and once for the digests of the rows that share both. What is broadcast
    are at most ``classes`` numbers of each level and fewer group keys than
    ``PARTS_PER_PARTITION`` for each shuffle partition. Where ``classes`` is
    small for the number of rows, more whole texts are hashed and the result
    is the same.
    """
    refined = _refined(docs, classes)
    columns = ["id", "digest"]
    if with_digest:
        refined = refined.withColumn("sha", F.coalesce("digest", F.sha2("text", 256)))
        columns.append("sha")
    # The place is stored with the row, so that it is the same in every later read.
    rows = stored(refined.select(*columns, F.monotonically_increasing_id().alias("place")), "digests")
    found = _matched(rows, _groups(rows))
    alone = F.col("group").isNull()
    made = [
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("group.keep_id")).alias("keep_id"),
        F.coalesce("group.n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("group.best_place") == F.col("place"))).alias("kept"),
    ]
    return found.select(*made, *([F.col("sha").alias("text_sha256")] if with_digest else []))


def drop_copies(docs: DataFrame, classes: int = CLASSES) -> DataFrame:
    """The rows that stay, with all their columns: of equal texts that of the largest ``doc_id``.

    Rows that share both id and text are one document, of which any row stays.
    Null ids and texts, ties and empty tables are as in ``copies``.
    """
    row = F.struct(*(F.col(name).alias(f"c{i}") for i, name in enumerate(docs.columns)))
    digest = F.sha2(_whole(F.col("text")), 256)
    keyed = docs.select(F.col("doc_id").alias("id"), digest.alias("digest"), row.alias("row"))
    verdicts = copies(docs, True, classes).groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("repeats")
    )
    verdicts = verdicts.where("kept").select(F.col("doc_id").alias("of"), F.col("text_sha256").alias("sha"), "repeats")
    match = F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("sha"))
    kept = keyed.join(verdicts, match)
    # Most documents have one row; only the others are gathered once more.
    some = kept.where("repeats > 1").groupBy("id", "digest").agg(F.first("row").alias("row"))
    kept = kept.where("repeats = 1").select("row").unionByName(some.select("row"))
    return kept.select(*(F.col(f"row.c{i}").alias(name) for i, name in enumerate(docs.columns)))
