"""Layers laid out by month and by policy, distinct rows by fingerprint, bitmaps, grouping sets."""

import datetime as dt
import pathlib
import shutil

import pytest
from pyspark.sql import functions as F

from claimstrata import operators as ops
from claimstrata import plans
from claimstrata.operators import distinct
from claimstrata.registry import queries
from claimstrata.sinks import months, read_months, replace_month, write_layer, write_months

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(repr, df.collect()))


# Months.

SALES = [(i, dt.date(2023, 1 + i % 3, 1 + i % 28) if i % 10 else None) for i in range(600)]


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(SALES, "id int, sale_day date").repartition(6)


def test_months_read_one_directory(spark, sales, tmp_path):
    layer = write_months(sales, f"{tmp_path}/sales")
    assert rows_of(layer.drop("sale_month")) == rows_of(sales)
    march = layer.where("sale_month = 202303")
    assert "PartitionFilters: [isnotnull(sale_month" in plan(march)
    read = march.select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all("/sale_month=202303/" in row.f for row in read)
    assert layer.where("sale_month IS NULL").count() == 60


def test_slice_of_the_month_layout_opens_that_month_only(spark):
    layer = queries._by_month(spark, SF_DIR)
    files = layer.where("sale_month = 199803").select(F.input_file_name()).distinct().count()
    df = queries.month_pruned(spark, SF_DIR)
    assert "PartitionFilters: [isnotnull(sale_month" in plan(df)
    assert len(df.collect()) == 1
    assert 0 < _files_read(df) == files < len(layer.inputFiles())


def _files_read(df):
    """The files that the scans of an executed query opened, by Spark's own count."""
    final = df._jdf.queryExecution().executedPlan().executedPlan()
    total, stack = 0, [final]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() in ("FileSourceScanExec",):
            total += node.metrics().apply("numFiles").value()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_a_hot_month_fills_several_files(spark, settings, tmp_path):
    rows = spark.range(200_000, numPartitions=8).select(
        F.md5(F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 > 0, F.lit(dt.date(2023, 3, 4))).otherwise(F.lit(dt.date(2023, 1, 4))).alias("sale_day"),
    )
    with settings({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):
        write_months(rows, f"{tmp_path}/hot")
    files = list(pathlib.Path(f"{tmp_path}/hot/sale_month=202303").glob("*.parquet"))
    assert 3 <= len(files) <= 16
    assert read_months(spark, f"{tmp_path}/hot", rows.schema).count() == 200_000


def test_one_month_is_replaced_alone(spark, sales, tmp_path):
    path = f"{tmp_path}/sales"
    layer = write_months(sales, path)
    others = {p: p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet") if "202302" not in str(p)}
    replace_month(layer.where("sale_month = 202302 AND id < 300"), path, 202302)
    again = read_months(spark, path, sales.schema)
    kept = [r for r in SALES if r[1] is None or r[1].month != 2 or r[0] < 300]
    assert sorted(r.id for r in again.collect()) == sorted(i for i, _ in kept)
    assert all(p.stat().st_mtime_ns == t for p, t in others.items())


def test_a_month_without_rows_goes_and_foreign_rows_do_not_come(spark, sales, tmp_path):
    path = f"{tmp_path}/sales"
    write_months(sales, path)
    replace_month(sales.where("month(sale_day) = 1"), path, 202302)
    replace_month(sales.where("false"), path, None)
    left = read_months(spark, path, sales.schema)
    assert {r.sale_month for r in left.select("sale_month").distinct().collect()} == {202301, 202303}
    assert not pathlib.Path(months.month_directory(path, None)).exists()
    replace_month(sales, path, None)
    assert read_months(spark, path, sales.schema).where("sale_day IS NULL").count() == 60


def test_empty_layer_of_months(spark, sales, tmp_path):
    assert write_months(sales.where("false"), f"{tmp_path}/none").count() == 0


# Distinct rows by fingerprint.

DOUBLES = [(1, "a", None), (1, "a", None), (None, "a", 1), (1, "a", 1), (None, None, None), (None, None, None), (2, "", 2)]


@pytest.fixture
def doubles(spark):
    return spark.createDataFrame(DOUBLES, "x int, shared string, y int").repartition(4)


@pytest.mark.parametrize("bits", [None, 1, 2])
@pytest.mark.parametrize("most", [0, 100])
def test_fingerprint_clashes_keep_different_rows(spark, doubles, bits, most):
    fingerprint = None if bits is None else F.pmod(distinct.row_fingerprint(doubles), F.lit(bits))
    found = ops.drop_copies_by_fingerprint(doubles, fingerprint, most)
    assert found.columns == doubles.columns
    assert rows_of(found) == rows_of(doubles.dropDuplicates())
    assert ops.drop_copies_by_fingerprint(doubles.where("false")).count() == 0


def test_rows_without_a_copy_are_not_shuffled(spark, tmp_path):
    rows = spark.range(20_000, numPartitions=4).withColumn("text", F.repeat(F.md5(F.col("id").cast("string")), 20))
    rows = write_layer(rows.unionByName(rows.where("id < 10")), f"{tmp_path}/rows")
    shuffled = []
    for form in (ops.drop_copies, ops.drop_copies_by_fingerprint):
        df = form(rows)
        assert len(df.collect()) == 20_000
        shuffled.append(_shuffled_rows(df))
    assert shuffled[0] == 20_010 and 10 <= shuffled[1] <= 20


def _shuffled_rows(df):
    total, stack = 0, [df._jdf.queryExecution().executedPlan().executedPlan()]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


# Bitmaps of codes.

CODES = [0, 1, -1, 1, 32_767, 32_768, 32_769, -32_768, -32_769, 2**31 - 1, -(2**31), None, None, 7, 7]


def test_bitmaps_of_extreme_codes(spark):
    df = spark.createDataFrame([(c,) for c in CODES], "customer_code int").repartition(3)
    bitmaps = ops.code_bitmaps(df)
    assert ops.count_codes(bitmaps).first()[0] == len(set(CODES))
    assert bitmaps.count() <= len({None if c is None else c // 32_768 for c in CODES}) + 2


def test_bitmaps_of_parts_are_merged(spark):
    parts = [CODES[::2], CODES[1::2], [], [5]]
    frames = [ops.code_bitmaps(spark.createDataFrame([(c,) for c in p], "customer_code int")) for p in parts]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    assert ops.count_codes(ops.merge_bitmaps(merged)).first()[0] == len({*CODES, 5})
    assert ops.count_codes(ops.merge_bitmaps(merged.where("false"))).first()[0] == 0


def test_bitmaps_shuffle_buckets_not_codes(spark):
    df = spark.range(100_000, numPartitions=4).select(F.col("id").cast("int").alias("customer_code"))
    counted = ops.count_codes(ops.merge_bitmaps(ops.code_bitmaps(df)))
    assert counted.collect()[0][0] == 100_000
    assert _shuffled_rows(counted) < 100


# All distributions at once.


def test_distributions_scan_once_and_equal_the_single_ones(spark):
    rows = queries.bronze_layer(spark, SF_DIR)
    names = ("age_group", "acquisition_channel", "city")
    found = ops.distributions(rows, names)
    assert plan(found).count("FileScan") == 1 and plan(found).count("Exchange") == 1
    for name in names:
        mine = found.where(F.col("dimension") == name).select(F.col("value").alias(name), "customer_count")
        assert rows_of(mine) == rows_of(ops.distribution(rows, name))


def test_null_values_are_no_totals(spark):
    df = spark.createDataFrame([(None, "x", 1), (None, None, 2), ("b", None, None)], "a string, b string, customer_code int")
    found = {(r.dimension, r.value): r.customer_count for r in ops.distributions(df, ("a", "b")).collect()}
    assert found == {("a", None): 2, ("a", "b"): 0, ("b", "x"): 1, ("b", None): 1}


# Documents and metrics in the same buckets.


def test_layout_joins_without_exchange(spark, settings):
    with settings({"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        df = queries.enrich_colocated(spark, SF_DIR)
        text = plan(df)
    assert "Exchange" not in text and text.count("Bucketed: true") == 2


def test_hot_policies_and_rows_without_one_fill_many_buckets(spark, tmp_path):
    docs = spark.range(9000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('p', id) END").alias("policy_id"),
        F.array(F.col("id").cast("int")).alias("claims"),
        *(F.lit(None).cast("int").alias(n) for n in plans.BRONZE_COLUMNS if n not in ("policy_id", "claim_amount")),
    )
    docs = write_layer(docs, f"{tmp_path}/docs")
    metrics = write_layer(ops.policy_metrics(ops.explode_claims(docs)), f"{tmp_path}/metrics")
    layout = plans.write_policy_layout(docs, metrics, f"{tmp_path}/layout", "hot_policies", 16, floor=1, parts=64)
    sizes = spark.table("hot_policies_documents").groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 2 * 9000 / 16
    got = layout.claim_policy(spark).select("policy_id", "claim_amount", "total_claims")
    want = plans.gold_claim_policy(docs, metrics).select("policy_id", "claim_amount", "total_claims")
    assert rows_of(got) == rows_of(want) and got.count() == 9000

    # Another session's catalog does not know the tables.
    spark.sql("DROP TABLE hot_policies_documents")
    spark.sql("DROP TABLE hot_policies_metrics")
    assert rows_of(layout.claim_policy(spark).select("policy_id", "claim_amount", "total_claims")) == rows_of(want)
    for name in ("documents", "metrics"):
        spark.sql(f"DROP TABLE hot_policies_{name}")
    shutil.rmtree(f"{tmp_path}/layout")
