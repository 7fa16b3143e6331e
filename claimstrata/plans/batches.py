"""Policy metrics from stored partial figures of input batches."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from claimstrata.sinks.files import LAYER_CODEC, MAX_RECORDS_PER_FILE, write_layer
from claimstrata.sinks.lineage import new_folder
from claimstrata.sinks.storage import Store

# A batch's figures lie in so many parts by policy, so that a refresh opens only those it needs.
PARTS = 64
PARTIALS = StructType(
    [
        StructField("policy_id", StringType()),
        StructField("rows", LongType()),
        StructField("total", LongType()),
        StructField("known", LongType()),
        StructField("batch", StringType()),
        StructField("part", IntegerType()),
    ]
)


def _part(policy: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(policy, F.lit(""))), F.lit(PARTS)).cast("int")


def partial_metrics(rows: DataFrame) -> DataFrame:
    """``policy_id, rows, total, known``: claim rows, their sum and how many have an amount. NULL is a policy."""
    return rows.groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("claim_amount").alias("total"),
        F.count("claim_amount").alias("known"),
    )


def store_batch(rows: DataFrame, path: str, batch: str) -> DataFrame:
    """Store the partial figures of one batch of claim rows under ``path``; returns the policies it changes.

    A batch that is stored again takes the place of what it left before, so
    it counts once however often it comes; a batch without rows leaves
    nothing. The result, ``policy_id, part``, has the policies of the batch's
    present and earlier form. New files are staged, and the old ones go when
    they are complete. One writer per batch at a time.
    """
    if not re.fullmatch("[A-Za-z0-9.-]+", batch):
        raise ValueError(f"a batch name has letters, digits, points and dashes: {batch!r}")
    spark = rows.sparkSession
    store, place = Store(spark, path), f"{path}/batch={batch}"
    staged = f"{path}/_incoming-{uuid.uuid4().hex}"
    figures = partial_metrics(rows).withColumn("part", _part(F.col("policy_id")))
    writer = figures.repartition(PARTS, "part").write.partitionBy("part")
    writer.options(maxRecordsPerFile=MAX_RECORDS_PER_FILE, compression=LAYER_CODEC).parquet(staged)
    some = any(name.startswith("part=") for name in store.names(staged))

    present = StructType([field for field in PARTIALS if field.name != "batch"])
    forms = [x for x in (staged if some else None, place if store.exists(place) else None) if x]
    policies = spark.createDataFrame([], present)
    for form in forms:
        policies = policies.unionByName(spark.read.schema(present).parquet(form))
    changed = policies.select("policy_id", "part").distinct()
    changed = write_layer(changed, new_folder(spark, "changed_policies"))

    store.delete(place)
    if some:
        store.rename(staged, place)
    else:
        store.delete(staged)
    return changed


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The partial figures of all batches, with ``batch`` and ``part``."""
    if not any(name.startswith("batch=") for name in Store(spark, path).names(path)):
        return spark.createDataFrame([], PARTIALS)
    return spark.read.schema(PARTIALS).parquet(path)


def merged_metrics(partials: DataFrame) -> DataFrame:
    """``operators.policy_metrics`` of all rows of the batches."""
    total = F.sum("total")
    return partials.groupBy("policy_id").agg(
        F.sum("rows").alias("total_claims"),
        total.alias("total_claim_amount"),
        F.try_divide(total, F.sum("known")).alias("avg_claim_amount"),
    )


def refreshed_metrics(metrics: DataFrame, partials: DataFrame, changed: DataFrame) -> DataFrame:
    """Metrics from before a batch came, with those of the policies it ``changed`` made anew.

    Only figures of these policies are merged, from the parts that they lie
    in; the rows of other policies are passed on as they are. Store the result
    before a batch that it reads is stored again.
    """
    mine = changed.select(F.col("policy_id").alias("changed_id"), F.col("part").alias("changed_part"))
    same = partials["policy_id"].eqNullSafe(mine["changed_id"])
    again = merged_metrics(partials.join(mine, (partials["part"] == mine["changed_part"]) & same, "left_semi"))
    others = metrics.join(mine, metrics["policy_id"].eqNullSafe(mine["changed_id"]), "left_anti")
    return others.unionByName(again)
