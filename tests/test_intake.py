"""Lines that do not fit the schema, and fields that the schema does not have."""

import json
import re

import pytest
from pyspark.sql import functions as F

from claimstrata import plans
from claimstrata.registry import queries
from claimstrata.sources import declared_fields, found_fields, read_documents, read_variants, undeclared_fields

LINES = [
    '{"_id":{"$oid":"1"},"customer_code":{"$numberInt":"5"},"claims":[{"$numberInt":"3"}]}',
    '{"_id":{"$oid":"2"},"pii_fields":{"pan_number":"SECRET1","aadhaar_number":"SECR',
    '{"_id":{"$oid":"2"},"pii_fields":{"pan_number" : "SE\\"CRET","x":1}',
    "[1,2]",
    "null",
    "garbage",
    '{"_id":{"$oid":"3"},"customer_code":5,"claims":[{"$numberInt":"3"}]}',
    '{"_id":{"$oid":"4"},"claims":[{"$numberInt":"3"},5]}',
    "",
    "{}",
    '{"_id":{"$oid":"5"},"claims":[{"$numberInt":"x"}],"extra":1}',
]


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(LINES) + "\n")
    (folder / "b.json").write_text("garbage\n" + LINES[0] + "\n")
    return str(folder)


def test_bad_lines_are_stored_once(spark, source, tmp_path):
    good, bad = plans.store_checked(spark, source, f"{tmp_path}/layer")
    found = sorted((row.source_file.rsplit("/", 1)[1], row.reason, row.line) for row in bad.collect())
    assert [(f, r) for f, r, _ in found] == [
        ("a.json", "no object"),
        ("a.json", "no object"),
        ("a.json", "not JSON"),
        ("a.json", "not JSON"),
        ("a.json", "not JSON"),
        ("a.json", "type of a field"),
        ("a.json", "type of a field"),
        ("b.json", "not JSON"),
    ]
    assert not any("SECR" in line or "CRET" in line for _, _, line in found)
    assert sum('"pan_number":"***"' in line for _, _, line in found) == 2
    assert good.count() == 4


def test_good_rows_are_as_without_the_check(spark, source, tmp_path):
    good, _ = plans.store_checked(spark, source, f"{tmp_path}/layer")
    plain = plans.documents(read_documents(spark, source))
    assert good.dtypes == plain.dtypes
    kept = plain.where("customer_code = 5 OR claims IS NULL OR claims[0] IS NULL")
    codes = sorted(str(row) for row in good.where("customer_code = 5").collect())
    assert codes == sorted(str(row) for row in kept.where("customer_code = 5").collect())


def test_the_json_is_read_once_and_good_rows_are_picked_by_directory(spark, source, tmp_path):
    good, bad = plans.store_checked(spark, source, f"{tmp_path}/layer")
    for df in (good, bad):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(rejected" in text and "FileScan json" not in text


def test_empty_source(spark, tmp_path):
    (tmp_path / "none.json").write_text("")
    good, bad = plans.store_checked(spark, f"{tmp_path}/none.json", f"{tmp_path}/layer")
    assert good.count() == bad.count() == 0


def test_declared_fields():
    found = declared_fields("a struct<b: array<struct<c: string>>, d: int>, e array<array<double>>")
    assert found == {"a.b[].c": "STRING", "a.d": "BIGINT", "e[][]": "DOUBLE"}


def test_undeclared_fields(spark, tmp_path):
    documents = [
        {"_id": {"$oid": "1"}, "city": 7, "new": {"deep": [{"er": [True]}, None]}},
        {"_id": None, "claims": [], "sale": {}, "new": {}, "a.b": 1},
        {"claims": [{"$numberInt": "1"}, {"$numberInt": 1, "x": 1.5}]},
    ]
    lines = [json.dumps(x) for x in documents] + ["5", "broken{", "[[]]"]
    (tmp_path / "d.json").write_text("\n".join(lines))
    docs = read_variants(spark, f"{tmp_path}/d.json")
    found = {(r.path, r.type): r.n for r in undeclared_fields(docs).collect()}
    assert found == {
        ("city", "BIGINT"): 1,
        ("new.deep[].er[]", "BOOLEAN"): 1,
        ("new.deep[]", "VOID"): 1,
        ("new", "OBJECT<>"): 1,
        ("a.b", "BIGINT"): 1,
        ("claims[].$numberInt", "BIGINT"): 1,
        ("claims[].x", "DECIMAL(2,1)"): 1,
        ("", "BIGINT"): 1,
        ("[]", "ARRAY<VOID>"): 1,
    }
    shallow = {(r.path, r.type) for r in found_fields(docs, 2).collect()}
    assert ("new.deep", "ARRAY<OBJECT<er: ARRAY<BOOLEAN>>>") in shallow
    assert undeclared_fields(docs.where("false")).count() == 0


def test_fields_are_counted_in_one_scan_without_a_wide_shuffle(spark):
    df = queries.field_drift(spark, "/root/testdata/sf0.001")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "partial_count" in text
    assert df.agg(F.sum("n")).first()[0] > 0


def test_undeclared_fields_are_found_fields_without_declared_ones(spark, tmp_path):
    lines = [
        '{"sale": {"sale_id": {"$numberInt": "1"}, "STRING city": "x"}, "city": "a", "STRING city": "b"}',
        '{"city": null, "sale.sale_date": "2", "sale": {"sale_date": 3}, "claims": [[], {}, null, "x", [{"a": {}}]]}',
        '{"a b": {"": [1, 2.5, {"city": "c"}]}, "claims": {"$numberInt": "1"}, "age": [], "day": [null]}',
        '{"l1": {"l2": {"l3": {"l4": {"l5": {"l6": {"l7": {"l8": {"l9": 1}, "m8": []}}}}}}}}',
        "null", "[]", "{}", '"text"', "[null]",
    ]
    (tmp_path / "d.json").write_text("\n".join(lines))
    docs = read_variants(spark, f"{tmp_path}/d.json")
    declared = declared_fields()
    known = {""} | {path[:i] for path in declared for i in range(len(path) + 1) if path[i : i + 1] in (".", "[", "")}
    for depth in (1, 2, 8):
        found = {(r.path, r.type): r.n for r in found_fields(docs, depth).collect()}
        for path, kind in list(found):
            empty = kind in ("OBJECT<>", "ARRAY<VOID>", "VOID") and path in known
            if declared.get(path) == kind or empty:
                del found[path, kind]
        assert {(r.path, r.type): r.n for r in undeclared_fields(docs, depth=depth).collect()} == found and found


def test_no_level_copies_the_document(spark):
    df = queries.field_drift(spark, "/root/testdata/sf0.001")
    text = df._jdf.queryExecution().executedPlan().toString()
    steps = re.findall(r"Generate variant_explode\w*\([^)]*\), \[([^\]]*)\]", text)
    assert len(steps) == 8
    assert all(len(carried.split(",")) <= 3 for carried in steps)
    # Each level looks a path and type up once; a comparison for every declared field costs most of the time.
    assert max(line.count(" = ") for line in text.splitlines()) < 10
