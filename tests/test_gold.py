import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimstrata.operators import (
    attach_policy_metrics,
    distribution,
    monthly_revenue,
    monthly_slice,
    policy_metrics,
    total_customers,
)
from claimstrata.plans import bronze, gold_claim_policy
from claimstrata.registry.queries import claim_rows, documents_layer
from claimstrata.sinks import write_layer

SF_DIR = "/root/testdata/sf0.001"
ROWS = "policy_id string, claim_amount int"
SHUFFLED = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def attached(df, **split):
    return attach_policy_metrics(df, policy_metrics(df), **split)


def test_null_policy_and_null_amounts(spark):
    df = spark.createDataFrame([("p", 1), ("p", None), (None, 5), ("q", None)], ROWS)
    rows = sorted(map(tuple, attached(df).collect()), key=str)
    assert rows == sorted(
        [
            ("p", 1, 2, 1, 1.0),
            ("p", None, 2, 1, 1.0),
            (None, 5, None, None, None),
            ("q", None, 1, None, None),
        ],
        key=str,
    )
    assert attached(df).columns[0] == "policy_id"


def test_null_is_a_policy_in_the_metrics(spark):
    df = spark.createDataFrame([(None, 5), (None, None), ("p", 2)], ROWS)
    got = {r.policy_id: tuple(r)[1:] for r in policy_metrics(df).collect()}
    assert got == {None: (2, 5, 5.0), "p": (1, 2, 2.0)}


@pytest.mark.parametrize("plan", [{}, SHUFFLED], ids=["broadcast", "shuffled"])
@hypothesis_settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    rows=st.lists(
        st.tuples(
            st.one_of(st.none(), st.sampled_from(["a", "b", "c", ""])),
            st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_against_brute_force_with_slices(spark, settings, plan, rows):
    def measures(policy):
        if policy is None:
            return (None, None, None)
        mine = [amount for key, amount in rows if key == policy]
        known = [amount for amount in mine if amount is not None]
        if not known:
            return (len(mine), None, None)
        return (len(mine), sum(known), sum(known) / len(known))

    want = sorted(((p, a, *measures(p)) for p, a in rows), key=str)
    with settings(plan):
        got = attached(spark.createDataFrame(rows, ROWS), parts=4, floor=2).collect()
    assert sorted(map(tuple, got), key=str) == want


def skewed(spark):
    """Line items with a third of the rows on one policy and a third on none."""
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    third = F.col("l_orderkey") % 3
    return lines.select(
        F.when(third == 1, "hot").when(third == 2, F.concat(F.lit("P"), "l_orderkey")),
        F.col("l_extendedprice").cast("int"),
    ).toDF("policy_id", "claim_amount")


@pytest.mark.parametrize("partitions", [16, 64])
def test_hot_policy_and_missing_policies_are_spread(spark, settings, tmp_path, partitions):
    rows = skewed(spark)
    metrics = write_layer(policy_metrics(rows), str(tmp_path / "metrics"))
    fixed = {**SHUFFLED, "spark.sql.adaptive.enabled": "false"}
    with settings({**fixed, "spark.sql.shuffle.partitions": str(partitions)}):
        out = attach_policy_metrics(rows, metrics, floor=1)
        sizes = [
            r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
        ]
        whole = rows.count()
    assert sum(sizes) == whole
    assert max(sizes) < 2 * whole / partitions


@pytest.mark.parametrize("plan", [{}, SHUFFLED], ids=["broadcast", "shuffled"])
def test_hot_policy_keeps_every_row(spark, settings, tmp_path, plan):
    rows = skewed(spark)
    metrics = write_layer(policy_metrics(rows), str(tmp_path / "metrics"))
    with settings(plan):
        out = attach_policy_metrics(rows, metrics, parts=200, floor=100)
        plain = rows.join(metrics, "policy_id", "left")
        assert out.columns == plain.columns
        assert out.exceptAll(plain).count() == plain.exceptAll(out).count() == 0


def test_late_explode_equals_row_join(spark):
    docs, rows = documents_layer(spark, SF_DIR), bronze(documents_layer(spark, SF_DIR))
    metrics = policy_metrics(rows)
    late = gold_claim_policy(docs, metrics, parts=50, floor=10)
    plain = attach_policy_metrics(rows, metrics)
    assert late.columns == plain.columns
    assert late.exceptAll(plain).count() == plain.exceptAll(late).count() == 0
    assert late.count() == rows.count()


def test_metrics_account_for_every_row(spark):
    rows = claim_rows(spark, SF_DIR)
    known = policy_metrics(rows).where("policy_id is not null")
    assert (
        known.agg(F.sum("total_claims")).first()[0]
        == rows.where("policy_id is not null").count()
    )


def test_total_customers_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "customer_code int")
    assert total_customers(df).first().total_customers == 2


def test_distribution_counts_rows_with_a_code(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", None), (None, 3)], "city string, customer_code int"
    )
    got = {r.city: r.customer_count for r in distribution(df, "city").collect()}
    assert got == {"a": 2, None: 1}


DATES = {
    "2023-03-05": 3,
    "2023-3-5": 3,
    "2023-03": 3,
    "2023-03-05T10:11:12": 3,
    "2023-03-05T00:00:00.000Z": 3,
    "2023-03-05 10:11:12": 3,
    " 2023-03-05 ": 3,
    "05-03-2023": None,
    "2023/03/05": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_date_texts(spark, settings, ansi):
    with settings({"spark.sql.ansi.enabled": ansi}):
        for text, month in DATES.items():
            df = spark.createDataFrame(
                [(text, 10, 1)], "sale_date string, revenue_amt int, customer_code int"
            )
            row = monthly_revenue(df).first()
            assert (row.month, row.total_revenue, row.total_customers) == (month, 10, 1), text


@pytest.mark.parametrize("month", [1, 3, 12])
def test_slice_is_the_month_of_the_whole(spark, month):
    rows = claim_rows(spark, SF_DIR)
    whole = monthly_revenue(rows).where(f"year = 1998 and month = {month}")
    for part in (
        monthly_slice(rows, 1998, month),
        monthly_slice(rows, 1998, month, F.col("sale_day")),
    ):
        assert part.collect() == whole.collect()
        assert part.count() == 1


def test_slice_of_an_empty_month(spark):
    assert monthly_slice(claim_rows(spark, SF_DIR)).count() == 0


def test_empty_frames(spark):
    empty = spark.createDataFrame([], ROWS)
    assert attached(empty).count() == 0
    only_null = spark.createDataFrame([(None, 1)], ROWS)
    assert [tuple(row) for row in attached(only_null).collect()] == [(None, 1, None, None, None)]
    unmatched = attach_policy_metrics(
        spark.createDataFrame([("p", 1)], ROWS), policy_metrics(empty)
    )
    assert [tuple(row) for row in unmatched.collect()] == [("p", 1, None, None, None)]
