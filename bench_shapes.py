"""Times the chosen plan shapes against the obvious ones, in one session.

Prints one JSON line per comparison. Same settings as ``bench.py``; the forms
of a comparison take turns, so that a slow spell of the machine hits them alike.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstrata import operators as ops
from claimstrata import plans
from claimstrata.operators import distinct
from claimstrata.plans.publish import DIMENSIONS
from claimstrata.registry import queries as registry
from claimstrata.session import local_session
from claimstrata.sinks import MONTH_COLUMN, new_folder, write_csv, write_layer, write_months

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def compute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def compare(name: str, forms: dict) -> None:
    times: dict[str, list[float]] = {form: [] for form in forms}
    for turn in range(RUNS + 1):
        for form, run in forms.items():
            start = time.perf_counter()
            run()
            if turn:
                times[form].append(time.perf_counter() - start)
    medians = {form: round(statistics.median(values), 3) for form, values in times.items()}
    print(json.dumps({"comparison": name, "cpus": CPUS, "sec": medians}), flush=True)


def shuffled_bytes(df: DataFrame) -> int:
    """Bytes that the exchanges of a query write, after running it."""
    execution = df._jdf.queryExecution()
    total, stack = 0, [execution.executedPlan().executedPlan()]
    while stack:
        node = stack.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleBytesWritten").value()
        if kind.endswith("QueryStageExec"):
            stack.append(node.plan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def tenfold(docs: DataFrame) -> DataFrame:
    """Ten documents for each, with numbers of their own, in the shared folder."""
    spark = docs.sparkSession
    many = docs.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(9))))
    many = many.withColumn("revenue_id", F.col("revenue_id") + F.col("turn") * 10_000_000).drop("turn")
    return write_layer(many, new_folder(spark, "tenfold"))


def main() -> None:
    spark = local_session(CPUS, "shapes")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.shuffle.partitions", CPUS)
    wire = registry.wire(spark, SF_DIR)
    docs = registry.documents_layer(spark, SF_DIR)
    rows = registry.bronze_layer(spark, SF_DIR)

    def three_joins() -> None:
        measures = (
            F.count(F.lit(1)).alias("total_claims"),
            F.sum("claim_amount").alias("total_claim_amount"),
            F.avg("claim_amount").alias("avg_claim_amount"),
        )
        sides = [rows.groupBy("policy_id").agg(measure) for measure in measures]
        compute(reduce(lambda df, side: df.join(side, "policy_id", "left"), sides, rows))

    def stored_metrics(source: DataFrame) -> DataFrame:
        return write_layer(ops.policy_metrics(source), new_folder(spark, "policy_metrics"))

    forms = {
        "three groupings, three joins": three_joins,
        "one grouping, join on rows": lambda: compute(
            ops.attach_policy_metrics(rows, stored_metrics(rows))
        ),
        "one grouping, join on documents": lambda: compute(
            plans.gold_claim_policy(docs, stored_metrics(plans.bronze(docs)))
        ),
    }
    compare("policy metrics, small enough to broadcast", forms)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    compare("policy metrics, too large to broadcast", forms)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    compare(
        "bronze from JSON",
        {
            "hash after the explode": lambda: compute(
                ops.mask_fields(ops.explode_claims(ops.flatten(wire)))
            ),
            "hash before the explode": lambda: compute(
                plans.bronze(ops.mask_fields(ops.flatten(wire)))
            ),
        },
    )
    compare(
        "silver",
        {
            "from bronze rows": lambda: compute(plans.silver(rows, registry.AS_OF)),
            "from documents": lambda: compute(plans.silver(plans.bronze(docs), registry.AS_OF)),
        },
    )
    compare(
        "bronze as CSV",
        {
            "one file": lambda: write_csv(rows.coalesce(1), new_folder(spark, "csv")),
            "a file per task": lambda: write_csv(rows, new_folder(spark, "csv")),
        },
    )
    compare(
        "one month",
        {
            "parsed from text": lambda: compute(ops.monthly_slice(rows, 1998, 3)),
            "from the stored date": lambda: compute(
                ops.monthly_slice(plans.bronze(docs, "sale_day"), 1998, 3, F.col("sale_day"))
            ),
        },
    )
    compare(
        "three distributions",
        {
            "a scan each": lambda: [compute(ops.distribution(rows, by)) for by in DIMENSIONS],
            "grouping sets": lambda: compute(ops.distributions(rows, DIMENSIONS)),
        },
    )
    months = write_months(docs, new_folder(spark, "months"))
    compare(
        "one month of documents laid out by month",
        {
            "all months": lambda: compute(
                ops.monthly_slice(plans.bronze(docs, "sale_day"), 1998, 3, F.col("sale_day"))
            ),
            "its directory": lambda: compute(
                ops.monthly_slice(
                    plans.bronze(months, "sale_day", MONTH_COLUMN), 1998, 3, F.col("sale_day"), MONTH_COLUMN
                )
            ),
        },
    )

    def distinct_rows(name: str, frame: DataFrame) -> None:
        """Seconds and exchanged bytes of both forms; a count in place of a sink keeps their exchanges."""

        def counted(df: DataFrame) -> DataFrame:
            return df.agg(F.max(F.xxhash64(*df.columns)), F.count(F.lit(1)))

        prints = frame.select(distinct.row_fingerprint(frame).alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"))
        prints = prints.where("n > 1").agg(F.count(F.lit(1)))
        prints.collect()
        before = {ops.drop_copies: 0, ops.drop_copies_by_fingerprint: shuffled_bytes(prints)}
        for form in (*before, *before):
            start = time.perf_counter()
            one = counted(form(frame))
            rows_ = one.collect()[0][1]
            megabytes = (before[form] + shuffled_bytes(one)) // 1_000_000
            figures = {"sec": round(time.perf_counter() - start, 1), "MB": megabytes, "rows": rows_}
            print(json.dumps({"comparison": f"{name}, {form.__name__}", **figures}), flush=True)

    many = tenfold(docs)
    filled = ops.fill_nulls(ops.project_silver(plans.bronze(many)))
    distinct_rows("distinct rows of ten times the data", filled)
    again = filled.unionByName(filled.where("revenue_id % 10 = 0"))
    distinct_rows("distinct rows, every tenth sale twice", again)
    one_sale = F.col("revenue_id") % 10_000_000
    distinct_rows("distinct rows, each ten times", filled.withColumn("revenue_id", one_sale.cast("int")))

    metrics = write_layer(ops.policy_metrics(plans.bronze(many)), new_folder(spark, "policy_metrics"))
    layout = plans.write_policy_layout(many, metrics, new_folder(spark, "by_policy"), buckets=32)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    compare(
        "policy join of ten times the data",
        {
            "shuffled": lambda: compute(plans.gold_claim_policy(many, metrics)),
            "in buckets": lambda: compute(layout.claim_policy(spark)),
        },
    )
    spark.stop()


if __name__ == "__main__":
    main()
