"""Claim metrics per policy, and their join back to the rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstrata.operators.narrow import long_digests, short_digests
from claimstrata.session import shuffle_partitions

# A policy with more than one part in so many of an average shuffle partition's
# claims is spread over several tasks, unless it has no more than SPLIT_FLOOR claims.
PARTS_PER_PARTITION = 8
SPLIT_FLOOR = 100_000


def policy_metrics(df: DataFrame) -> DataFrame:
    """Claim rows, claim sum and claim mean per policy; NULL is a policy of its own.

    One grouping for the three measures. NULL amounts count as rows but take
    no part in sum and mean. The mean is the exact bigint sum over the count,
    so it does not depend on the order in which partial sums arrive.
    """
    amount = F.sum("claim_amount")
    return df.groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("total_claims"),
        amount.alias("total_claim_amount"),
        F.try_divide(amount, F.count("claim_amount")).alias("avg_claim_amount"),
    )


def split_limit(metrics: DataFrame, parts: int | None = None, floor: int = SPLIT_FLOOR) -> tuple[int, int]:
    """Claims that one slice of a policy may hold, and the claims of the largest known policy.

    ``parts`` follows the number of shuffle partitions unless given, so a
    slice is an eighth of an average partition at most.
    """
    if parts is None:
        parts = PARTS_PER_PARTITION * shuffle_partitions(metrics.sparkSession)
    known = F.col("policy_id").isNotNull()
    size = F.col("total_claims")
    total, largest = metrics.agg(F.sum(size), F.max(F.when(known, size))).first()
    return max(math.ceil((total or 0) / parts), floor), largest or 0


def deal_slices(
    df: DataFrame, metrics: DataFrame, limit: int, largest: int, name: str = "policy_slice"
) -> DataFrame:
    """Rows with the number of their policy's slice; rows without a policy get one of their own each."""
    known = F.col("policy_id").isNotNull()
    turn = F.monotonically_increasing_id()
    own_slice = F.lit(0)
    if largest > limit:
        size = F.col("total_claims")
        large = metrics.where(known & (size > limit)).select("policy_id", F.ceil(size / limit).alias("_slices"))
        df = df.join(F.broadcast(large), "policy_id", "left")
        deal = F.pmod(F.xxhash64(turn), "_slices")
        own_slice = F.when(F.col("_slices").isNull(), 0).otherwise(deal)
    return df.withColumn(name, F.when(known, own_slice).otherwise(turn)).drop("_slices")


def repeat_for_slices(metrics: DataFrame, limit: int, name: str = "policy_slice") -> DataFrame:
    """The metrics of each known policy once for each of its slices."""
    slices = F.ceil(F.col("total_claims") / limit)
    known = metrics.where(F.col("policy_id").isNotNull())
    return known.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)))


def attach_policy_metrics(
    df: DataFrame,
    metrics: DataFrame,
    parts: int | None = None,
    floor: int = SPLIT_FLOOR,
) -> DataFrame:
    """Left join of ``policy_metrics`` output to rows that have a ``policy_id``.

    Every row is kept once. Rows without a policy get NULL metrics. The key
    comes first in the result, as after any join on a column name.

    Balance: the metrics know the size of each policy. A policy above the
    limit is cut into slices of at most the limit, its rows dealt out over
    the slices and its metrics repeated per slice. Only the names of such
    policies are broadcast. Each holds over 1/``parts`` of all claims, so
    there are fewer than ``parts`` of them whatever the size of the data, and
    the repeats add fewer than twice ``parts`` rows. Rows without a policy
    match nothing and are dealt out one by one. ``parts`` follows the number
    of shuffle partitions unless given, so a slice is an eighth of an average
    partition at most.

    Hand in ``metrics`` read from a stored table and ``df`` from a stored
    layer. The metrics are read at once for their total and their largest
    policy, two numbers, and again by the join, where their file size tells
    Spark whether to broadcast them whole. A stored ``df`` keeps the dealing
    the same when a lost task runs again. Digests of identity fields are
    shuffled as bytes.
    """
    limit, largest = split_limit(metrics, parts, floor)
    dealt = short_digests(deal_slices(df, metrics, limit, largest, "_slice"))
    sliced = repeat_for_slices(metrics, limit, "_slice")
    return long_digests(dealt.join(sliced, ["policy_id", "_slice"], "left").drop("_slice"), df)
