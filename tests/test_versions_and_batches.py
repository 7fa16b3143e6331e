"""Versioned exports, partial metrics of batches, and figures taken while writing."""

import datetime as dt
import gzip
import pathlib

import pytest
from pyspark.sql import functions as F

from claimstrata import operators as ops
from claimstrata import plans
from claimstrata.registry import queries
from claimstrata.sinks import (
    Store,
    current_version,
    damaged_files,
    read_manifest,
    read_version,
    versions,
    write_counted,
    write_csv,
    write_version,
)

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(repr, df.collect()))


# Versions.


@pytest.fixture
def export(spark, tmp_path):
    path = f"{tmp_path}/export"
    write_version(spark, path, lambda folder: _two_parts(spark.range(100, numPartitions=3), folder))
    return path


def _two_parts(df, folder):
    write_csv(df, f"{folder}/rows")
    write_csv(df.where("id < 5"), f"{folder}/gold/few", gather=True)


def ids(spark, path, part="rows"):
    return sorted(row.id for row in read_version(spark, path, part, spark.range(1).schema).collect())


def test_a_version_has_a_manifest_of_all_its_files(spark, export):
    folder = current_version(spark, export)
    found = {(row.part, row.file): row.lines for row in read_manifest(spark, folder).collect()}
    files = {("rows", p.name) for p in pathlib.Path(folder, "rows").glob("*.csv")}
    files |= {("gold/few", p.name) for p in pathlib.Path(folder, "gold/few").glob("*.csv")}
    assert set(found) == files and sum(found.values()) == 105 + len(files)
    assert damaged_files(spark, folder).count() == 0
    victim = next(pathlib.Path(folder, "rows").glob("*.csv"))
    victim.write_text(victim.read_text().replace("7", "8"))
    (victim.parent / f".{victim.name}.crc").unlink()
    assert [row.file for row in damaged_files(spark, folder).collect()] == [victim.name]


def test_readers_keep_the_old_export_when_a_file_fails(spark, export):
    def broken(folder):
        write_csv(spark.range(3), f"{folder}/rows")
        bad = spark.range(10, numPartitions=4).withColumn(
            "x", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise("x")
        )
        write_csv(bad, f"{folder}/gold/few")

    with pytest.raises(Exception, match="lost"):
        write_version(spark, export, broken)
    assert ids(spark, export) == list(range(100)) and ids(spark, export, "gold/few") == list(range(5))
    assert len(Store(spark, export).names(export)) == 1


def test_readers_keep_the_old_export_when_the_manifest_fails(spark, export, monkeypatch):
    def broken(*_):
        raise RuntimeError("no manifest")

    monkeypatch.setattr(versions, "_checksums", broken)
    with pytest.raises(RuntimeError, match="no manifest"):
        write_version(spark, export, lambda folder: _two_parts(spark.range(3), folder))
    assert ids(spark, export) == list(range(100))


def test_a_version_without_manifest_is_not_seen_and_goes(spark, export):
    dead = f"{export}/{versions._PREFIX}29990101T000000000000-dead"
    write_csv(spark.range(1), f"{dead}/rows")
    assert ids(spark, export) == list(range(100))
    stale = f"{export}/{versions._PREFIX}19990101T000000000000-dead"
    write_csv(spark.range(1), f"{stale}/rows")
    for n in (1, 2, 3):
        write_version(spark, export, lambda folder, n=n: _two_parts(spark.range(n), folder))
        assert ids(spark, export) == list(range(n))
    assert not pathlib.Path(stale).exists()
    assert len([x for x in Store(spark, export).names(export) if "dead" not in x]) == 2


def test_no_version_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        current_version(spark, f"{tmp_path}/nothing")


def test_a_whole_run_is_exported_at_once(spark, tmp_path):
    queries.wire(spark, SF_DIR)
    source = queries._stored[(spark.sparkContext.applicationId, SF_DIR, "wire")]
    layers = plans.publish(spark, source, f"{tmp_path}/layers", dt.date(2024, 7, 1), (1998, 3), checked=True)
    folder = plans.export_csv_version(layers, f"{tmp_path}/csv")
    parts = {row.part for row in read_manifest(spark, folder).select("part").distinct().collect()}
    assert parts == {"bronze", "silver"} | {f"gold/{x}" for x in ("claim_policy", "age_group", "acquisition_channel", "march_data")}
    assert layers.rejected.count() == 0
    assert layers.figures["bronze"].rows == layers["bronze"].count()


# Batches.

CLAIMS = [("a", 1), ("a", None), ("b", 5), (None, 2), (None, None), ("c", None), ("", 4)]


def claims(spark, rows):
    return spark.createDataFrame(rows, "policy_id string, claim_amount int").repartition(2)


def metrics_of(rows):
    out = {}
    for policy in {p for p, _ in rows}:
        known = [x for p, x in rows if p == policy and x is not None]
        total = sum(known) if known else None
        out[policy] = (sum(p == policy for p, _ in rows), total, total / len(known) if known else None)
    return out


def as_dict(df):
    return {r.policy_id: (r.total_claims, r.total_claim_amount, r.avg_claim_amount) for r in df.collect()}


def test_batches_merge_to_one_run_and_count_once(spark, tmp_path):
    path = f"{tmp_path}/partials"
    assert plans.read_batches(spark, path).count() == 0
    for _ in range(2):
        plans.store_batch(claims(spark, CLAIMS[:4]), path, "b1")
        plans.store_batch(claims(spark, CLAIMS[4:]), path, "b-2")
    merged = plans.merged_metrics(plans.read_batches(spark, path))
    assert as_dict(merged) == metrics_of(CLAIMS)
    whole = ops.policy_metrics(claims(spark, CLAIMS))
    assert merged.dtypes == whole.dtypes and rows_of(merged) == rows_of(whole)


def test_a_late_batch_touches_its_policies_only(spark, tmp_path):
    path = f"{tmp_path}/partials"
    plans.store_batch(claims(spark, CLAIMS), path, "b1")
    metrics = as_frame(spark, path)
    late = [("b", 7), (None, 1), ("new", 3)]
    changed = plans.store_batch(claims(spark, late), path, "b2")
    assert sorted(str(r.policy_id) for r in changed.collect()) == ["None", "b", "new"]
    marked = metrics.withColumn("total_claims", F.when(F.col("policy_id") == "c", 99).otherwise(F.col("total_claims")))
    after = as_dict(plans.refreshed_metrics(marked, plans.read_batches(spark, path), changed))
    want = metrics_of(CLAIMS + late)
    want["c"] = (99, *want["c"][1:])
    assert after == want


def as_frame(spark, path):
    found = plans.merged_metrics(plans.read_batches(spark, path))
    return spark.createDataFrame(found.collect(), found.schema)


def test_a_batch_that_comes_again_smaller_or_empty(spark, tmp_path):
    path = f"{tmp_path}/partials"
    plans.store_batch(claims(spark, CLAIMS), path, "b1")
    plans.store_batch(claims(spark, [("a", 1), ("gone", 2)]), path, "b2")
    metrics = as_frame(spark, path)
    changed = plans.store_batch(claims(spark, [("a", 10)]), path, "b2")
    assert {r.policy_id for r in changed.collect()} == {"a", "gone"}
    after = plans.refreshed_metrics(metrics, plans.read_batches(spark, path), changed)
    after = spark.createDataFrame(after.collect(), after.schema)
    assert as_dict(after) == metrics_of([*CLAIMS, ("a", 10)])
    changed = plans.store_batch(claims(spark, []), path, "b2")
    again = plans.refreshed_metrics(after, plans.read_batches(spark, path), changed)
    assert as_dict(again) == metrics_of(CLAIMS)
    with pytest.raises(ValueError):
        plans.store_batch(claims(spark, CLAIMS), path, "a/b=c")


# Figures.


def test_figures_are_those_of_the_written_rows(spark, tmp_path):
    rows = [(1, 2**62, "a"), (None, 2**62, None), (3, 2**62, "")]
    df = spark.createDataFrame(rows, "i int, `b.c` long, s string").repartition(3)
    layer, figures = write_counted(df, f"{tmp_path}/x", columns=True)
    assert layer.count() == figures.rows == 3
    assert figures.nulls == {"i": 1, "b.c": 0, "s": 1} and figures.sums == {"i": 4, "b.c": 3 * 2**62}
    _, empty = write_counted(df.where("i > 9"), f"{tmp_path}/y", columns=True)
    assert (empty.rows, empty.sums["i"]) == (0, 0)


def test_packed_files_are_listed_read_and_checked(spark, tmp_path):
    path = f"{tmp_path}/packed"
    df = spark.range(100, numPartitions=3)
    folder = write_version(spark, path, lambda new: write_csv(df, f"{new}/rows", packed=True))
    files = {p.name for p in pathlib.Path(folder, "rows").glob("*.csv.gz")}
    found = {row.file: row.lines for row in read_manifest(spark, folder).collect()}
    assert set(found) == files and len(files) == 3 and sum(found.values()) == 103
    assert ids(spark, path) == list(range(100))
    assert damaged_files(spark, folder).count() == 0
    victim = pathlib.Path(folder, "rows", min(files))
    victim.write_bytes(gzip.compress(gzip.decompress(victim.read_bytes()).replace(b"7", b"8")))
    (victim.parent / f".{victim.name}.crc").unlink()
    pathlib.Path(folder, "rows", max(files)).unlink()
    assert {row.file for row in damaged_files(spark, folder).collect()} <= files
    assert max(files) in {row.file for row in damaged_files(spark, folder).collect()}
