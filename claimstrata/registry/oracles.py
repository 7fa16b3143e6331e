"""The same results in SQL, straight from the given tables.

``_DOCS`` states the document rules of ``wire.py`` and the decoding in one
step; ``_BRONZE`` adds one row per claim by a join with the positions 1 to 5,
and ``_SILVER`` the cleaning. The queries build on these.
"""

from __future__ import annotations

from claimstrata.operators import SILVER_COLUMNS
from claimstrata.plans import BRONZE_COLUMNS

_SALE_DATE = """
    CASE WHEN l_orderkey % 97 = 0 THEN NULL
         WHEN l_orderkey % 13 = 0 THEN strftime(l_shipdate, '%d-%m-%Y')
         WHEN l_orderkey % 13 = 1 THEN ' ' || strftime(l_shipdate, '%Y-%m-%d') || ' '
         WHEN l_orderkey % 13 = 2 THEN strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00.000Z'
         WHEN l_orderkey % 13 = 3 THEN NULL
         WHEN l_orderkey % 13 = 4 THEN year(l_shipdate) || '-' || month(l_shipdate)
                                       || '-' || day(l_shipdate)
         ELSE strftime(l_shipdate, '%Y-%m-%d') END
"""

# NULL where the sale date text above is missing or no date to Spark.
_SALE_DAY = """
    CASE WHEN l_orderkey % 97 = 0 OR l_orderkey % 13 IN (0, 3) THEN NULL
         ELSE CAST(l_shipdate AS DATE) END
"""

_DOCS = f"""
docs AS (
  SELECT
    CASE WHEN l_partkey % 37 <> 0 THEN TRY_CAST(l_partkey AS INTEGER) END AS customer_code,
    CASE WHEN l_partkey % 43 = 0 OR l_partkey % 17 = 0 THEN NULL
         WHEN l_partkey % 41 = 0 THEN CAST(-(l_partkey % 60) AS INTEGER)
         ELSE CAST(18 + l_partkey % 60 AS INTEGER) END AS age,
    'Band ' || (l_suppkey % 5) AS age_group,
    CASE WHEN l_suppkey % 31 <> 0 THEN 'City ' || (l_suppkey % 25) END AS city,
    'Channel ' || l_returnflag AS acquisition_channel,
    CASE WHEN l_orderkey % 101 <> 0 THEN 'POL' || l_orderkey END AS policy_id,
    CAST(floor(l_extendedprice) AS INTEGER) AS base_coverage_amt,
    CAST(floor(l_extendedprice / 100) AS INTEGER) AS base_premium_amt,
    strftime(l_shipdate, '%Y-%m-%d') AS "date",
    CAST(day(l_shipdate) AS INTEGER) AS "day",
    CAST(month(l_shipdate) AS INTEGER) AS "month",
    CAST(year(l_shipdate) AS INTEGER) AS "year",
    CASE WHEN isodow(l_shipdate) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
    '2024-07-01' AS injection_date,
    CASE WHEN l_orderkey % 97 <> 0 THEN TRY_CAST(l_orderkey AS INTEGER) END AS sale_id,
    {_SALE_DATE} AS sale_date,
    CASE WHEN l_orderkey % 97 <> 0
         THEN CAST(floor(l_extendedprice / 90) AS INTEGER) END AS final_premium_amt,
    CASE WHEN l_orderkey % 97 <> 0 THEN l_linestatus END AS sales_mode,
    TRY_CAST(l_orderkey AS INTEGER) AS revenue_id,
    strftime(l_shipdate, '%Y-%m-%d') AS revenue_date,
    CAST(floor(l_extendedprice / 10) AS INTEGER) AS revenue_amt,
    CASE WHEN l_partkey % 29 <> 0 THEN 'PAN' || l_partkey END AS pan_number,
    'AAD' || l_suppkey AS aadhaar_number,
    {_SALE_DAY} AS sale_day,
    l_orderkey, l_partkey, l_linenumber, l_extendedprice
  FROM lineitem)
"""


def _claim(position: str) -> str:
    """The decoded claim at a position: NULL for a missing number, whole for one with a fraction."""
    return f"""
        CASE WHEN (l_partkey + {position}) % 19 = 0 THEN NULL
             ELSE CAST(floor(l_extendedprice / {position}) AS INTEGER) END"""


def _claim_text(position: str) -> str:
    """The claim text at a position of the array, as it stands in the document."""
    return f"""
        CASE WHEN (l_partkey + {position}) % 19 = 0 THEN NULL
             WHEN (l_partkey + {position}) % 23 = 0
             THEN CAST(floor(l_extendedprice / {position}) AS BIGINT) || '.5'
             ELSE CAST(CAST(floor(l_extendedprice / {position}) AS BIGINT) AS VARCHAR) END"""


# A row per position of the array, or one without position.
_POSITIONS = """
docs LEFT JOIN (VALUES (1), (2), (3), (4), (5)) AS positions(i)
  ON i <= l_linenumber AND l_linenumber <= 5"""

_SLOTS = """
    CASE WHEN l_linenumber <= 5 THEN CAST(l_linenumber AS INTEGER)
         WHEN l_linenumber = 6 THEN 0 END"""

_MASKED = """sha256(pan_number) AS pan_number_encrypted,
       sha256(aadhaar_number) AS aadhaar_number_encrypted"""

_BRONZE = f"""
WITH {_DOCS},
bronze AS (
  SELECT docs.*, {_claim("i")} AS claim_amount, {_MASKED}
  FROM docs JOIN (VALUES (1), (2), (3), (4), (5)) AS positions(i)
    ON i <= l_linenumber AND l_linenumber <= 5)
"""

_NUMBERS = {
    "sale_id",
    "final_premium_amt",
    "revenue_id",
    "revenue_amt",
    "customer_code",
    "age",
    "base_coverage_amt",
    "base_premium_amt",
    "day",
    "month",
    "year",
    "claim_amount",
}


def _list(columns: tuple[str, ...]) -> str:
    return ", ".join(f'"{name}"' for name in columns)


_FILLED = ", ".join(
    f'coalesce("{name}", {0 if name in _NUMBERS else "''"}) AS "{name}"'
    for name in SILVER_COLUMNS
)

_SILVER = f"""{_BRONZE},
silver_rows AS (SELECT DISTINCT {_FILLED} FROM bronze),
silver AS (
  SELECT * REPLACE (regexp_replace(CAST(age AS VARCHAR), '[^a-zA-Z0-9 ]', ' ', 'g') AS age),
         strftime(DATE '2024-07-01', '%d-%m-%Y') AS etl_date
  FROM silver_rows)
"""


def _metrics(rows: str) -> str:
    return f"""
metrics AS (
  SELECT policy_id, count(*) AS total_claims,
         CAST(sum(claim_amount) AS BIGINT) AS total_claim_amount,
         avg(claim_amount) AS avg_claim_amount
  FROM {rows} GROUP BY policy_id)"""


def _enriched(ctes: str, rows: str, columns: str) -> str:
    return f"""{ctes}, {_metrics(rows)}
SELECT {columns}, total_claims, total_claim_amount, avg_claim_amount
FROM {rows} r LEFT JOIN (SELECT policy_id AS metric_key, total_claims, total_claim_amount,
                                avg_claim_amount FROM metrics) m
  ON r.policy_id = m.metric_key"""


def _distribution(by: str) -> str:
    return f"""{_BRONZE}
SELECT {by}, count(customer_code) AS customer_count FROM bronze GROUP BY {by}"""


def _monthly(ctes: str, rows: str, day: str, where: str = "") -> str:
    return f"""{ctes}
SELECT CAST(year({day}) AS INTEGER) AS "year", CAST(month({day}) AS INTEGER) AS "month",
       CAST(sum(revenue_amt) AS BIGINT) AS total_revenue,
       count(customer_code) AS total_customers
FROM {rows} {where} GROUP BY 1, 2"""


# Silver keeps the text only: recover the day from the forms that are dates.
_SILVER_DAY = "TRY_CAST(left(trim(sale_date), 10) AS DATE)"
_SILVER_DAY = f"CASE WHEN sale_date LIKE '__-__-____' THEN NULL ELSE {_SILVER_DAY} END"

_BRONZE_LIST = _list(BRONZE_COLUMNS)
_ENRICHED_BRONZE = _enriched(_BRONZE, "bronze", _BRONZE_LIST)

ORACLES: dict[str, str] = {
    "read_wire": f"""
WITH {_DOCS}
SELECT to_hex(l_orderkey) || '-' || l_linenumber AS oid,
       CASE WHEN l_partkey % 37 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS customer_code,
       CASE WHEN l_partkey % 43 = 0 THEN 'x' ELSE CAST(age AS VARCHAR) END AS age,
       age_group, city, acquisition_channel, policy_id,
       CAST(base_coverage_amt AS VARCHAR) AS base_coverage_amt,
       CAST(base_premium_amt AS VARCHAR) AS base_premium_amt,
       CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS sale_id,
       sale_date,
       CAST(final_premium_amt AS VARCHAR) AS final_premium_amt, sales_mode,
       CAST(l_orderkey AS VARCHAR) AS revenue_id, revenue_date,
       CAST(revenue_amt AS VARCHAR) AS revenue_amt,
       {_SLOTS} AS claim_slots,
       CAST(i - 1 AS INTEGER) AS position,
       CASE WHEN i IS NOT NULL THEN {_claim_text("i")} END AS claim,
       "date", CAST("day" AS VARCHAR) AS "day", CAST("month" AS VARCHAR) AS "month",
       CAST("year" AS VARCHAR) AS "year", day_type, pan_number, aadhaar_number, injection_date
FROM {_POSITIONS}""",
    "flatten_wire": f"""
WITH {_DOCS}
SELECT * EXCLUDE (sale_day, l_orderkey, l_partkey, l_linenumber, l_extendedprice) FROM docs""",
    "unwrap_array": f"""
WITH {_DOCS}
SELECT revenue_id, customer_code, {_SLOTS} AS claim_slots, CAST(i - 1 AS INTEGER) AS position,
       CASE WHEN i IS NOT NULL THEN {_claim("i")} END AS claim
FROM {_POSITIONS}""",
    "explode_claims": f"""{_BRONZE}
SELECT revenue_id, customer_code, policy_id, sale_date, claim_amount FROM bronze""",
    "mask_fields": f"""
WITH {_DOCS}
SELECT * EXCLUDE (sale_day, l_orderkey, l_partkey, l_linenumber, l_extendedprice,
                  pan_number, aadhaar_number), {_MASKED}
FROM docs""",
    "bronze": f"{_BRONZE} SELECT {_BRONZE_LIST} FROM bronze",
    "checkpoint_bronze": f"{_BRONZE} SELECT {_BRONZE_LIST} FROM bronze",
    "silver_project": f"{_BRONZE} SELECT {_list(SILVER_COLUMNS)} FROM bronze",
    "stamp_etl_date": f"""{_BRONZE}
SELECT revenue_id, claim_amount, strftime(DATE '2024-07-01', '%d-%m-%Y') AS etl_date FROM bronze""",
    "fill_nulls": f"{_BRONZE} SELECT {_FILLED} FROM bronze",
    "dedup_rows": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "strip_special": """
SELECT c_custkey,
       regexp_replace(c_name, '[^a-zA-Z0-9 ]', ' ', 'g') AS c_name,
       regexp_replace(CAST(CAST(trunc(c_acctbal) AS INTEGER) AS VARCHAR),
                      '[^a-zA-Z0-9 ]', ' ', 'g') AS balance
FROM customer""",
    "silver": f"{_SILVER} SELECT * FROM silver",
    "policy_metrics": f"{_BRONZE}, {_metrics('bronze')} SELECT * FROM metrics",
    "policy_total_claims": f"""{_BRONZE}
SELECT policy_id, count(*) AS total_claims FROM bronze GROUP BY policy_id""",
    "policy_total_amount": f"""{_BRONZE}
SELECT policy_id, CAST(sum(claim_amount) AS BIGINT) AS total_claim_amount
FROM bronze GROUP BY policy_id""",
    "policy_avg_amount": f"""{_BRONZE}
SELECT policy_id, avg(claim_amount) AS avg_claim_amount FROM bronze GROUP BY policy_id""",
    "enrich_policy_metrics": _ENRICHED_BRONZE,
    "enrich_rows": _ENRICHED_BRONZE,
    "enrich_silver": _enriched(_SILVER, "silver", "r.*"),
    "total_customers": f"""{_BRONZE}
SELECT count(*) AS total_customers FROM (SELECT DISTINCT customer_code FROM bronze)""",
    "dist_age_group": _distribution("age_group"),
    "dist_channel": _distribution("acquisition_channel"),
    "dist_city": _distribution("city"),
    "monthly_revenue": _monthly(_BRONZE, "bronze", "sale_day"),
    "monthly_slice": _monthly(
        _BRONZE,
        "bronze",
        "sale_day",
        "WHERE year(sale_day) = 1998 AND month(sale_day) = 3",
    ),
    "monthly_silver": _monthly(_SILVER, "silver", _SILVER_DAY),
    "csv_roundtrip": _distribution("age_group"),
    "csv_rows": f"""{_BRONZE}
SELECT * REPLACE (trim(sale_date) AS sale_date) FROM (SELECT {_BRONZE_LIST} FROM bronze)""",
    "published_rows": f"""{_SILVER}, {_metrics("bronze")}
SELECT 'documents' AS layer, count(*) AS n FROM lineitem
UNION ALL SELECT 'bronze', count(*) FROM bronze
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'policy_metrics', count(*) FROM metrics
UNION ALL SELECT 'claim_policy', count(*) FROM bronze
UNION ALL SELECT 'age_group', count(*) FROM (SELECT DISTINCT age_group FROM bronze)
UNION ALL SELECT 'acquisition_channel', count(*) FROM (
  SELECT DISTINCT acquisition_channel FROM bronze)
UNION ALL SELECT 'monthly_revenue', count(*) FROM (
  SELECT DISTINCT year(sale_day), month(sale_day) FROM bronze)
UNION ALL SELECT 'march_data', count(*) FROM (
  SELECT DISTINCT year(sale_day), month(sale_day) FROM bronze
  WHERE year(sale_day) = 1998 AND month(sale_day) = 3)""",
}

_CUT, _LIST, _UNTYPED, _DRIFTED = (f"l_orderkey % {n} = 0" for n in (53, 59, 61, 7))

ORACLES |= {
    "rejected_lines": f"""
SELECT to_hex(l_orderkey) || '-' || l_linenumber AS oid,
       CASE WHEN {_CUT} THEN 'not JSON' WHEN {_LIST} THEN 'no object' ELSE 'type of a field' END AS reason,
       true AS has_file
FROM lineitem WHERE {_CUT} OR {_LIST} OR {_UNTYPED}""",
    "checked_bronze": f"""{_BRONZE}
SELECT {_BRONZE_LIST} FROM bronze WHERE NOT ({_CUT} OR {_LIST} OR {_UNTYPED})""",
    "field_drift": f"""
WITH drifted AS (
  SELECT l_orderkey FROM lineitem WHERE {_DRIFTED} AND NOT ({_CUT} OR {_LIST} OR {_UNTYPED}))
SELECT * FROM (
  SELECT '[]' AS path, 'STRING' AS type, count(*) AS n FROM lineitem WHERE {_LIST} AND NOT {_CUT}
  UNION ALL SELECT 'sale', 'BIGINT', count(*) FROM lineitem WHERE {_UNTYPED} AND NOT ({_CUT} OR {_LIST})
  UNION ALL SELECT 'loyalty.tier', 'STRING', count(*) FROM drifted
  UNION ALL SELECT 'loyalty.points[]', 'BIGINT', 2 * count(*) FROM drifted
  UNION ALL SELECT 'renewed', 'BOOLEAN', count(*) FROM drifted)
WHERE n > 0""",
}

_DIMENSIONS = " UNION ALL ".join(
    f"SELECT '{by}' AS dimension, {by} AS value, count(customer_code) AS customer_count FROM bronze GROUP BY {by}"
    for by in ("age_group", "acquisition_channel", "city")
)

ORACLES |= {
    "silver_by_fingerprint": ORACLES["silver"],
    "enrich_colocated": _ENRICHED_BRONZE,
    "customers_merged": ORACLES["total_customers"],
    "customers_per_month": f"""{_BRONZE}
SELECT CAST(100 * year(sale_day) + month(sale_day) AS INTEGER) AS sale_month,
       count(DISTINCT customer_code) + max(CASE WHEN customer_code IS NULL THEN 1 ELSE 0 END) AS total_customers
FROM bronze GROUP BY 1""",
    "distributions": f"{_BRONZE} {_DIMENSIONS}",
    "month_pruned": ORACLES["monthly_slice"],
    "month_replaced": f"""{_BRONZE}
SELECT CAST(year(sale_day) AS INTEGER) AS "year", CAST(month(sale_day) AS INTEGER) AS "month",
       CAST(sum(CASE WHEN year(sale_day) = 1998 AND month(sale_day) = 3
                THEN 2 ELSE 1 END * revenue_amt) AS BIGINT) AS total_revenue,
       count(customer_code) AS total_customers
FROM bronze GROUP BY 1, 2""",
}

_MEASURES = ("total_claims", "total_claim_amount", "avg_claim_amount")


def _column_figures(layer: str, rows: str, columns: tuple[str, ...], numbers: set[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{layer}' AS layer, '{name}' AS "column", count(*) - count("{name}") AS nulls,
            {f'CAST(sum("{name}") AS BIGINT)' if name in numbers else "CAST(NULL AS BIGINT)"} AS total FROM {rows}"""
        for name in columns
    )


ORACLES |= {
    "csv_version": ORACLES["csv_rows"],
    "metrics_by_batch": ORACLES["policy_metrics"],
    "published_columns": f"""{_SILVER}, {_metrics("bronze")},
joined AS (SELECT b.*, m.* EXCLUDE (policy_id) FROM bronze b LEFT JOIN metrics m ON b.policy_id = m.policy_id)
{_column_figures("bronze", "bronze", BRONZE_COLUMNS, _NUMBERS)} UNION ALL
{_column_figures("silver", "silver", (*SILVER_COLUMNS, "etl_date"), _NUMBERS - {"age"})} UNION ALL
{_column_figures("claim_policy", "joined", (*BRONZE_COLUMNS, *_MEASURES), _NUMBERS | {*_MEASURES[:2]})}""",
}

# What a whole run stores, read back, is what the queries of its parts give.
ORACLES |= {
    "published_silver": ORACLES["silver"],
    "published_claim_policy": ORACLES["enrich_rows"],
    "published_age_group": ORACLES["dist_age_group"],
    "published_channel": ORACLES["dist_channel"],
    "published_march": ORACLES["monthly_slice"],
    "published_monthly": ORACLES["monthly_revenue"],
}
