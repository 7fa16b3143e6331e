"""Reading, flattening, exploding and masking of handcrafted documents."""

import hashlib
import json

import pytest

from claimstrata.operators import explode_claims, flatten, mask_fields
from claimstrata.plans import BRONZE_COLUMNS, bronze, documents

FULL = {
    "_id": {"$oid": "a1"},
    "customer_code": {"$numberInt": "7"},
    "age": {"$numberInt": "30"},
    "age_group": "26-35",
    "city": "X",
    "acquisition_channel": "Online",
    "policy_id": "P1",
    "base_coverage_amt": {"$numberInt": "1000"},
    "base_premium_amt": {"$numberInt": "10"},
    "sale": {
        "sale_id": {"$numberInt": "5"},
        "sale_date": "2023-03-05",
        "final_premium_amt": {"$numberInt": "11"},
        "sales_mode": "web",
    },
    "revenue": {
        "revenue_id": {"$numberInt": "6"},
        "revenue_date": "2023-03-06",
        "revenue_amt": {"$numberInt": "12"},
    },
    "claims": [{"$numberInt": "1"}, {"$numberInt": "2"}],
    "date": "2023-03-05",
    "day": {"$numberInt": "5"},
    "month": {"$numberInt": "3"},
    "year": {"$numberInt": "2023"},
    "day_type": "Weekend",
    "pii_fields": {"pan_number": "PAN1", "aadhaar_number": "AAD1"},
    "injection_date": "2024-07-01",
}


def line(**changes):
    return json.dumps({**FULL, **changes})


@pytest.fixture(params=["true", "false"], ids=["ansi", "not-ansi"])
def ansi(request, settings):
    with settings({"spark.sql.ansi.enabled": request.param}):
        yield


def claims_of(wire):
    return [row.claims for row in flatten(wire).select("claims").collect()]


def test_full_document(wire_lines, ansi):
    row = flatten(wire_lines(line())).first().asDict()
    assert list(row) == [
        "customer_code", "age", "age_group", "city", "acquisition_channel", "policy_id",
        "base_coverage_amt", "base_premium_amt", "claims", "date", "day", "month", "year",
        "day_type", "injection_date", "sale_id", "sale_date", "final_premium_amt", "sales_mode",
        "revenue_id", "revenue_date", "revenue_amt", "pan_number", "aadhaar_number",
    ]
    assert row["claims"] == [1, 2]
    assert (row["age"], row["sale_id"], row["revenue_amt"], row["year"]) == (30, 5, 12, 2023)
    assert (row["sale_date"], row["pan_number"]) == ("2023-03-05", "PAN1")


def test_number_where_text_is_declared_and_empty_claims(wire_lines, ansi):
    wire = wire_lines(line(age={"$numberInt": 31}, claims=[]))
    assert flatten(wire).first().age == 31
    assert claims_of(wire) == [[]]
    assert bronze(documents(wire)).count() == 0


def test_bare_number_and_null_claims(wire_lines, ansi):
    wire = wire_lines(line(age=32, claims=None))
    row = flatten(wire).first()
    assert (row.age, row.city) == (None, "X")
    assert claims_of(wire) == [None]
    assert bronze(documents(wire)).count() == 0


def test_other_wrapper_and_bad_elements(wire_lines, ansi):
    wire = wire_lines(line(age={"$numberLong": "33"}, claims=[{"$numberInt": "x"}, None]))
    assert flatten(wire).first().age is None
    assert claims_of(wire) == [[None, None]]
    assert [r.claim_amount for r in bronze(documents(wire)).collect()] == [None, None]


def test_unknown_key_fraction_and_overflow(wire_lines, ansi):
    wire = wire_lines(
        line(extra=1, claims=[{"$numberInt": "12.7"}, {"$numberInt": "99999999999"}])
    )
    assert claims_of(wire) == [[12, None]]


def test_null_struct_gives_null_leaves(wire_lines, ansi):
    row = flatten(wire_lines(line(sale=None, pii_fields=None))).first()
    assert (row.sale_id, row.sale_date, row.sales_mode, row.pan_number) == (None,) * 4


def test_malformed_blank_and_array_lines(wire_lines, ansi):
    two = f"[{line(claims=[{'$numberInt': '9'}])}, {line(claims=None)}]"
    wire = wire_lines(line()[:40], "", two)
    assert sorted(claims_of(wire), key=str) == [None, None, [9]]
    assert bronze(documents(wire)).count() == 1


def test_missing_keys(wire_lines, ansi):
    row = flatten(wire_lines('{"policy_id": "only"}')).first().asDict()
    assert row.pop("policy_id") == "only"
    assert set(row.values()) == {None}


def test_bronze_columns_and_row_count(wire_lines):
    wire = wire_lines(line(), line(claims=[None]), line(claims=[]))
    assert documents(wire).columns[-1] == "sale_day"
    rows = bronze(documents(wire))
    assert tuple(rows.columns) == BRONZE_COLUMNS
    sizes = [len(c or []) for c in claims_of(wire)]
    assert rows.count() == sum(sizes) == 3


def test_explode_then_mask_equals_mask_then_explode(wire_lines):
    flat = flatten(wire_lines(line(), line(pii_fields=None, claims=[{"$numberInt": "4"}])))
    late = explode_claims(mask_fields(flat)).select(*BRONZE_COLUMNS)
    early = mask_fields(explode_claims(flat))
    assert tuple(early.columns) == BRONZE_COLUMNS
    assert late.exceptAll(early).count() == early.exceptAll(late).count() == 0


def test_mask_hides_the_fields(wire_lines):
    masked = mask_fields(flatten(wire_lines(line(pii_fields={"pan_number": "PAN1"}))))
    assert not {"pan_number", "aadhaar_number"} & set(masked.columns)
    row = masked.first()
    assert row.pan_number_encrypted == hashlib.sha256(b"PAN1").hexdigest()
    assert row.aadhaar_number_encrypted is None


def test_mask_other_fields(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    assert mask_fields(df, ["n"]).first().n_encrypted == hashlib.sha256(b"1").hexdigest()
