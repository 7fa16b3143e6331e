"""The JSON source: nested claim documents, one per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The declared source schema. Every field may be NULL.
WIRE_SCHEMA = """
    _id struct<`$oid`: string>,
    customer_code struct<`$numberInt`: string>,
    age struct<`$numberInt`: string>,
    age_group string,
    city string,
    acquisition_channel string,
    policy_id string,
    base_coverage_amt struct<`$numberInt`: string>,
    base_premium_amt struct<`$numberInt`: string>,
    sale struct<
        sale_id: struct<`$numberInt`: string>,
        sale_date: string,
        final_premium_amt: struct<`$numberInt`: string>,
        sales_mode: string>,
    revenue struct<
        revenue_id: struct<`$numberInt`: string>,
        revenue_date: string,
        revenue_amt: struct<`$numberInt`: string>>,
    claims array<struct<`$numberInt`: string>>,
    `date` string,
    `day` struct<`$numberInt`: string>,
    `month` struct<`$numberInt`: string>,
    `year` struct<`$numberInt`: string>,
    day_type string,
    pii_fields struct<pan_number: string, aadhaar_number: string>,
    injection_date string
"""


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Documents from JSON lines under the declared schema.

    The schema is given, so no pass over the data infers it. Unknown keys
    are ignored, missing ones are NULL, and a malformed line gives a row of
    NULLs, which has no claims and so leaves with the explode.

    Plain files split at line ends, so one large file is read by many tasks.
    """
    return spark.read.schema(WIRE_SCHEMA).json(path)


def parse_documents(lines: DataFrame) -> DataFrame:
    """Documents from a frame with one JSON object per row in ``value``, as ``read_documents`` reads them.

    For lines that another step makes and that are read once, so that they
    need not be stored in between. A NULL, empty or malformed line gives a row
    of NULLs.
    """
    # With its mode named the parser is kept even where the plan itself makes the lines.
    document = F.from_json("value", WIRE_SCHEMA, {"mode": "PERMISSIVE"})
    return lines.select(document.alias("document")).select("document.*")
