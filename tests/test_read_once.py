"""Queries store no layer that is read once, layers number texts that come again, exports are hashed by file."""

import datetime as dt
import hashlib
import pathlib

import pytest
from pyspark.sql import functions as F

from claimstrata import operators as ops
from claimstrata import plans
from claimstrata.plans import policy_layout
from claimstrata.registry import queries
from claimstrata.sinks import current_version, read_csv, read_manifest, write_csv, write_layer, write_version

ITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Orders in three months of 1998, some rows twice and some with NULLs."""
    rows = [
        (i // 3, 7 * i, 3 * i % 90, 1 + i % 7, 100.0 + 13 * i, "ANR"[i % 3], "OF"[i % 2], dt.datetime(1998, 2 + i % 3, 1 + i % 28))
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


STORED = {"checkpoint_bronze": [], "csv_rows": ["documents"], "csv_version": ["documents"], "enrich_rows": ["documents"]}


@pytest.mark.parametrize("name", STORED)
def test_bronze_is_stored_by_none_that_reads_it_once(spark, sf_dir, name, tmp_path):
    found = queries.QUERIES[name](spark, sf_dir)
    rows = rows_of(found)
    assert stored_names() == STORED[name]
    bronze = queries.bronze_layer(spark, sf_dir)
    if name == "enrich_rows":
        assert rows == rows_of(ops.attach_policy_metrics(bronze, ops.policy_metrics(bronze)))
    elif name == "checkpoint_bronze":
        assert rows == rows_of(bronze)
    else:
        write_csv(bronze, f"{tmp_path}/plain")
        assert found.dtypes == bronze.dtypes and len(rows) == bronze.count()
        assert rows == rows_of(read_csv(spark, f"{tmp_path}/plain", bronze.schema))


def test_layers_number_digests_that_come_again(spark, tmp_path):
    # 25,000 persons of six sales each, far apart: their digests are 1.7 megabytes.
    person = F.pmod(F.xxhash64("id"), F.lit(25_000)).cast("string")
    sales = spark.range(150_000, numPartitions=1).select(F.sha2(person, 256).alias("digest"))
    layer = write_layer(sales, f"{tmp_path}/layer")
    assert sum(p.stat().st_size for p in pathlib.Path(f"{tmp_path}/layer").glob("part-*")) < 1.5 * 10**6
    assert layer.exceptAll(sales).count() == 0 and layer.count() == 150_000


def test_buckets_are_shuffled_with_digests_as_bytes(spark, tmp_path, monkeypatch):
    moved, write = [], policy_layout.write_buckets

    def seen(df, *rest, **more):
        moved.append(dict(df.dtypes))
        return write(df, *rest, **more)

    monkeypatch.setattr(policy_layout, "write_buckets", seen)
    texts = [hashlib.sha256(b"a").hexdigest(), hashlib.sha256(b"b").hexdigest().upper(), "", None, "a" * 32, "no digest"]
    docs = spark.range(60).select(
        F.concat(F.lit("p"), F.col("id") % 7).alias("policy_id"),
        F.array(F.col("id").cast("int")).alias("claims"),
        F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % 6 + 1).cast("int")).alias("pan_number_encrypted"),
        F.sha2(F.col("id").cast("string"), 256).alias("aadhaar_number_encrypted"),
        *(F.lit(None).cast("int").alias(n) for n in plans.BRONZE_COLUMNS if n != "policy_id" and n != "claim_amount" and "encrypted" not in n),
    )
    docs = write_layer(docs, f"{tmp_path}/docs")
    metrics = write_layer(ops.policy_metrics(ops.explode_claims(docs)), f"{tmp_path}/metrics")
    layout = plans.write_policy_layout(docs, metrics, f"{tmp_path}/layout", "digest_policies", 4)
    assert {moved[0][n] for n in moved[0] if "encrypted" in n} == {"binary"}
    want = plans.gold_claim_policy(docs, metrics)
    found = layout.claim_policy(spark)
    assert found.dtypes == want.dtypes and rows_of(found) == rows_of(want)
    for name in ("documents", "metrics"):
        spark.sql(f"DROP TABLE digest_policies_{name}")


def test_checksums_are_sums_of_hashes(spark, tmp_path):
    path = f"{tmp_path}/export"
    write_version(spark, path, lambda new: write_csv(spark.range(3000, numPartitions=3), f"{new}/a/b", packed=True))
    folder = current_version(spark, path)
    lines = spark.read.text(f"{folder}/a/b").select(
        F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1).alias("file"), F.xxhash64("value").alias("hash")
    )
    want = {}
    for row in lines.collect():
        count, total = want.get(row.file, (0, 0))
        want[row.file] = count + 1, total + row.hash
    manifest = read_manifest(spark, folder)
    assert dict(manifest.dtypes)["checksum"] == "decimal(38,0)"
    assert {r.file: (r.lines, int(r.checksum)) for r in manifest.collect()} == want
    assert {r.part for r in manifest.collect()} == {"a/b"}
