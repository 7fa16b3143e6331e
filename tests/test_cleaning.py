import datetime as dt

from claimstrata.operators import (
    SILVER_COLUMNS,
    drop_copies,
    fill_nulls,
    project_silver,
    stamp_etl_date,
    strip_column,
)
from claimstrata.plans import silver
from claimstrata.registry.queries import bronze_layer, claim_rows

SF_DIR = "/root/testdata/sf0.001"


def test_fill_touches_numbers_and_texts_only(spark):
    df = spark.sql(
        "select cast(null as int) i, cast(null as bigint) l, cast(null as double) d, "
        "cast(null as string) s, cast(null as boolean) b, cast(null as date) t, "
        "cast(null as array<int>) a"
    )
    assert tuple(fill_nulls(df).first()) == (0, 0, 0.0, "", None, None, None)


def test_copies_after_fill_collapse(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (None, "x"), (0, "x")], "n int, s string")
    filled = fill_nulls(df)
    assert sorted(map(tuple, drop_copies(filled).collect())) == [(0, "x"), (1, "")]
    assert drop_copies(df).count() == 4


def test_drop_copies_is_idempotent(spark):
    once = drop_copies(project_silver(bronze_layer(spark, SF_DIR)))
    assert drop_copies(once).count() == once.count()


def test_strip_column(spark):
    df = spark.createDataFrame([(-5, "a"), (31, "b"), (None, "c")], "age int, k string")
    out = strip_column(df, "age")
    assert out.columns == ["age", "k"]
    assert [r.age for r in out.orderBy("k").collect()] == [" 5", "31", None]


def test_stamp(spark):
    df = spark.range(1)
    assert stamp_etl_date(df, dt.date(2023, 3, 5)).first().etl_date == "05-03-2023"
    today = spark.sql("select date_format(current_date(), 'dd-MM-yyyy') d").first().d
    assert stamp_etl_date(df).first().etl_date == today


def test_silver_columns_and_order_of_steps(spark):
    rows = bronze_layer(spark, SF_DIR)
    out = silver(rows, dt.date(2024, 7, 1))
    assert tuple(out.columns) == (*SILVER_COLUMNS, "etl_date")
    assert dict(out.dtypes)["age"] == "string"
    stepwise = strip_column(
        drop_copies(fill_nulls(stamp_etl_date(project_silver(rows), dt.date(2024, 7, 1)))), "age"
    ).select(out.columns)
    assert out.exceptAll(stepwise).count() == stepwise.exceptAll(out).count() == 0


def test_a_third_of_all_rows_are_copies_of_one(spark):
    rows = project_silver(claim_rows(spark, SF_DIR))
    one = rows.limit(1)
    copies = one.crossJoin(spark.range(rows.count() // 2).select()).select(rows.columns)
    out = drop_copies(rows.unionByName(copies))
    assert out.exceptAll(drop_copies(rows)).count() == 0
    assert out.count() == drop_copies(rows).count()
