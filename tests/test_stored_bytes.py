"""What queries store on the way to their result, on line items made here."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimstrata import operators as ops
from claimstrata import plans
from claimstrata.registry import queries
from claimstrata.sinks import month_key, read_months, write_months
from claimstrata.sources import parse_documents, read_documents

ITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Orders in three months of 1998, some rows twice and some with NULLs."""
    rows = [
        (i, 7 * i, 3 * i % 90, 1 + i % 7, 100.0 + 13 * i, "ANR"[i % 3], "OF"[i % 2], dt.datetime(1998, 2 + i % 3, 1 + i % 28))
        for i in range(1, 700)
    ]
    rows += [*rows[:50], (None, None, None, 1, None, None, None, None), (5, 5, 5, None, 1.0, "A", "O", None)]
    path = str(tmp_path_factory.mktemp("items"))
    spark.createDataFrame(rows, ITEM).write.parquet(f"{path}/lineitem.parquet")
    return path


@pytest.fixture(autouse=True)
def nothing_stored(monkeypatch):
    monkeypatch.setattr(queries, "_stored", {})


def stored_names():
    return sorted(name for _, _, name in queries._stored)


def rows_of(df):
    return sorted(map(repr, df.collect()))


LINES = [
    '{"_id":{"$oid":"a"},"age":{"$numberInt":"4"},"claims":[{"$numberInt":"1"},null,{}],"more":1}',
    '{"age":{"$numberInt":5},"city":"","policy_id":null}',
    '{"age":{"$numberInt":"4"},"sale":7,"city":"x"}',
    '{"_id":{"$oid":"b"},"age":{"$num',
    "nothing",
    "{}",
]


def test_lines_are_parsed_as_files_are_read(spark, wire_lines):
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    parsed = parse_documents(lines)
    assert parsed.schema == wire_lines(*LINES).schema
    assert rows_of(parsed) == rows_of(wire_lines(*LINES))
    assert rows_of(parse_documents(lines.select(F.lit(None).cast("string").alias("value")))) == len(LINES) * rows_of(
        wire_lines("{}")
    )


def test_lines_made_in_the_plan_are_those_stored(spark, sf_dir):
    stored, made = queries.wire(spark, sf_dir), queries.parsed(spark, sf_dir)
    assert made.schema == stored.schema and rows_of(made) == rows_of(stored)
    path = queries._once(spark, sf_dir, "wire", None)
    assert rows_of(queries.wire_lines(spark, sf_dir)) == rows_of(spark.read.text(path))


@pytest.mark.parametrize("name", ["flatten_wire", "mask_fields", "unwrap_array", "explode_claims"])
def test_ingest_stores_no_lines_and_parses_all(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "StructsToJson" in text and "from_json(" in text
    found = rows_of(df)
    assert stored_names() == []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "parsed", queries.wire)
        assert found == rows_of(queries.QUERIES[name](spark, sf_dir))


COUNTS = ["dist_age_group", "dist_channel", "dist_city", "distributions", "total_customers", "csv_roundtrip"]


@pytest.mark.parametrize("name", COUNTS)
def test_counts_store_documents_alone(spark, sf_dir, name):
    found = rows_of(queries.QUERIES[name](spark, sf_dir))
    assert stored_names() == ["documents"]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "claim_rows", queries.bronze_layer)
        assert found == rows_of(queries.QUERIES[name](spark, sf_dir))


def test_months_are_laid_out_without_other_layers(spark, sf_dir):
    found = rows_of(queries.month_pruned(spark, sf_dir))
    assert stored_names() == ["documents_by_month"]
    rows = plans.bronze(queries.documents_layer(spark, sf_dir), "sale_day")
    assert found == rows_of(ops.monthly_slice(rows, queries.YEAR, queries.MONTH, F.col("sale_day")))
    docs, months = queries.documents_layer(spark, sf_dir), queries._by_month(spark, sf_dir)
    assert months.columns == [*docs.columns, "sale_month"]
    assert rows_of(months.drop("sale_month")) == rows_of(docs)


def test_month_replaced_stores_months_alone(spark, sf_dir):
    assert len(queries.month_replaced(spark, sf_dir).collect()) == 4
    assert stored_names() == []


def test_month_replaced_has_all_rows_and_one_month_twice(spark, sf_dir):
    found = rows_of(queries.month_replaced(spark, sf_dir))
    docs = queries.documents_layer(spark, sf_dir)
    mine = month_key(F.col("sale_day")) == 100 * queries.YEAR + queries.MONTH
    amount = F.when(mine, 2 * F.col("revenue_amt")).otherwise(F.col("revenue_amt"))
    rows = plans.bronze(docs.withColumn("revenue_amt", amount), "sale_day")
    assert found == rows_of(ops.monthly_revenue(rows, F.col("sale_day")))


def test_last_step_of_a_month_layout_follows_the_shuffle(spark, tmp_path):
    rows = spark.range(300).withColumn("sale_day", F.expr("add_months(date'2023-01-05', int(id % 3))"))
    seen = []

    def last(moved):
        seen.append(moved._jdf.queryExecution().analyzed().toString())
        return moved.select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), "sale_day", "sale_month")

    layer = write_months(rows, f"{tmp_path}/months", last=last)
    assert len(seen) == 1 and "RebalancePartitions" in seen[0].split("\n")[0]
    expected = [F.sha2(F.col("id").cast("string"), 256).alias("digest"), "sale_day", F.expr("202301 + int(id % 3) AS sale_month")]
    assert rows_of(layer) == rows_of(rows.select(*expected))
    assert rows_of(read_months(spark, f"{tmp_path}/months", layer.schema)) == rows_of(layer)
