"""Wire documents from the given tables, one per line item.

A document is a function of its line item alone. No grouping collects claims
into arrays, so an order with any number of lines costs no task more than its
rows. ``FIXTURES.md`` lists the rules; ``oracles.py`` states them again in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wire_documents(lineitem: DataFrame) -> DataFrame:
    """Line items in the shape of the declared source schema."""
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    day = F.col("l_shipdate").cast("date")
    day_text = F.date_format(day, "yyyy-MM-dd")
    return lineitem.select(
        F.struct(F.concat_ws("-", F.hex(order), line).alias("$oid")).alias("_id"),
        _wrap(F.when(part % 37 != 0, part)).alias("customer_code"),
        _wrap(_age(part)).alias("age"),
        F.concat(F.lit("Band "), supplier % 5).alias("age_group"),
        F.when(supplier % 31 != 0, F.concat(F.lit("City "), supplier % 25)).alias("city"),
        F.concat(F.lit("Channel "), "l_returnflag").alias("acquisition_channel"),
        F.when(order % 101 != 0, F.concat(F.lit("POL"), order)).alias("policy_id"),
        _wrap(_whole(price)).alias("base_coverage_amt"),
        _wrap(_whole(price / 100)).alias("base_premium_amt"),
        F.when(
            order % 97 != 0,
            F.struct(
                _wrap(order).alias("sale_id"),
                _sale_date(order, day, day_text).alias("sale_date"),
                _wrap(_whole(price / 90)).alias("final_premium_amt"),
                F.col("l_linestatus").alias("sales_mode"),
            ),
        ).alias("sale"),
        F.struct(
            _wrap(order).alias("revenue_id"),
            day_text.alias("revenue_date"),
            _wrap(_whole(price / 10)).alias("revenue_amt"),
        ).alias("revenue"),
        _claims(part, line, price).alias("claims"),
        day_text.alias("date"),
        _wrap(F.dayofmonth(day)).alias("day"),
        _wrap(F.month(day)).alias("month"),
        _wrap(F.year(day)).alias("year"),
        F.when(F.weekday(day) >= 5, "Weekend").otherwise("Weekday").alias("day_type"),
        F.struct(
            F.when(part % 29 != 0, F.concat(F.lit("PAN"), part)).alias("pan_number"),
            F.concat(F.lit("AAD"), supplier).alias("aadhaar_number"),
        ).alias("pii_fields"),
        F.lit("2024-07-01").alias("injection_date"),
    )


def odd_lines(lineitem: DataFrame) -> DataFrame:
    """The documents as text lines, some broken off, of another type, or with undeclared fields.

    Which of them follows from the order number; ``FIXTURES.md`` lists the rules.
    """
    docs = wire_documents(lineitem)
    fields = docs.columns
    order = F.col("revenue.revenue_id.$numberInt").cast("long")
    plain = F.to_json(F.struct(*fields))
    untyped = F.to_json(F.struct(*(F.lit(5).alias("sale") if name == "sale" else F.col(name) for name in fields)))
    loyalty = F.struct(F.lit("gold").alias("tier"), F.array(order, F.lit(2)).alias("points")).alias("loyalty")
    drifted = F.to_json(F.struct(*fields, loyalty, (order % 2 == 0).alias("renewed")))
    text = (
        F.when(order % 53 == 0, F.substring(plain, 1, 60))
        .when(order % 59 == 0, F.to_json(F.array(F.col("_id.$oid"))))
        .when(order % 61 == 0, untyped)
        .when(order % 7 == 0, drifted)
        .otherwise(plain)
    )
    return docs.select(text.alias("value"))


def _whole(number: Column) -> Column:
    return F.floor(number).cast("bigint")


def _wrap(value: Column) -> Column:
    return F.struct(value.cast("string").alias("$numberInt"))


def _age(part: Column) -> Column:
    return (
        F.when(part % 43 == 0, "x")
        .when(part % 17 == 0, None)
        .when(part % 41 == 0, (-(part % 60)).cast("string"))
        .otherwise((18 + part % 60).cast("string"))
    )


def _sale_date(order: Column, day: Column, day_text: Column) -> Column:
    form = order % 13
    return (
        F.when(form == 0, F.date_format(day, "dd-MM-yyyy"))
        .when(form == 1, F.concat(F.lit(" "), day_text, F.lit(" ")))
        .when(form == 2, F.concat(day_text, F.lit("T00:00:00.000Z")))
        .when(form == 3, None)
        .when(form == 4, F.date_format(day, "yyyy-M-d"))
        .otherwise(day_text)
    )


def _claims(part: Column, line: Column, price: Column) -> Column:
    def claim(position: Column) -> Column:
        amount = _whole(price / position)
        text = (
            F.when((part + position) % 19 == 0, None)
            .when((part + position) % 23 == 0, F.concat(amount, F.lit(".5")))
            .otherwise(amount.cast("string"))
        )
        return F.struct(text.alias("$numberInt"))

    return F.when(line <= 5, F.transform(F.sequence(F.lit(1), line), claim)).when(
        line == 6, F.array().cast("array<struct<`$numberInt`: string>>")
    )
