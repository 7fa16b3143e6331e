import datetime as dt
import pathlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter

from claimstrata.operators import distribution, monthly_slice
from claimstrata.plans import BRONZE_COLUMNS, export_csv, export_database, publish
from claimstrata.registry import queries
from claimstrata.sinks import (
    DatabaseTarget,
    checkpointed,
    database,
    persisted,
    read_csv,
    shared_folder,
    write_csv,
    write_layer,
    write_months,
    write_table,
)

SF_DIR = "/root/testdata/sf0.001"
AS_OF = dt.date(2024, 7, 1)


def part_files(path):
    return [p for p in pathlib.Path(path).iterdir() if p.name.startswith("part-")]


def test_csv_blanks_and_nulls(spark, tmp_path):
    texts = [None, "", " x ", "a,b", 'q"q']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").coalesce(1)
    path = str(tmp_path / "out")
    write_csv(df, path)
    lines = part_files(path)[0].read_text().splitlines()
    assert lines == ["i,s", "0,", '1,""', "2,x", '3,"a,b"', '4,"q\\"q"']
    back = read_csv(spark, path, df.schema).orderBy("i").collect()
    assert [r.s for r in back] == [None, None, "x", "a,b", 'q"q']


def test_csv_overwrite_and_empty_frame(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(spark.range(100), path)
    write_csv(spark.range(0), path)
    assert [p.read_text() for p in part_files(path)] == ["id\n"]


def test_csv_rejects_arrays(spark, tmp_path):
    with pytest.raises(AnalysisException):
        write_csv(spark.sql("select array(1) a"), str(tmp_path / "out"))


def test_gathered_csv_is_one_file_when_small(spark, tmp_path):
    groups = distribution(queries.bronze_layer(spark, SF_DIR), "city")
    path = str(tmp_path / "out")
    write_csv(groups, path, gather=True)
    assert len(part_files(path)) == 1
    assert read_csv(spark, path, groups.schema).exceptAll(groups).count() == 0


def test_row_level_csv_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(spark.range(10_000).repartition(6), path)
    assert len(part_files(path)) == 6


def test_layer_roundtrip_and_pruning(spark, tmp_path):
    rows = queries.bronze_layer(spark, SF_DIR)
    back = write_layer(rows, str(tmp_path / "layer"))
    assert back.schema == rows.schema
    assert back.exceptAll(rows).count() == rows.exceptAll(back).count() == 0
    plan = back.select("city").where("age > 3")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<age:int,city:string>" in plan
    assert "GreaterThan(age,3)" in plan


def test_checkpoint_cuts_the_plan(spark):
    rows = queries.bronze_layer(spark, SF_DIR).select(*BRONZE_COLUMNS)
    cut = checkpointed(rows)
    assert "parquet" not in cut._jdf.queryExecution().executedPlan().toString().lower()
    assert cut.exceptAll(rows).count() == 0 and cut.count() == rows.count()


def test_persisted_is_released(spark):
    df = spark.range(10)
    with persisted(df) as held:
        assert held.count() == 10
        assert held.storageLevel.useMemory and held.storageLevel.useDisk
    assert not df.storageLevel.useMemory


class _Context:
    def __init__(self, master):
        self.master = master
        self.applicationId = f"app-{master}"


class _Session:
    """The two parts of a session that choose the folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = _Context(master)
        self.conf = {"spark.checkpoint.dir": folder}


def test_shared_folder():
    assert shared_folder(_Session("spark://host", "/shared/x/")) == "/shared/x"
    assert shared_folder(_Session("local[2]", "/shared/x")) == "/shared/x"
    local = _Session("local[2]")
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("spark://host"))


# The database sink is tested up to the driver call. No database is started.

TARGET = DatabaseTarget(
    "jdbc:some:db", {"user": "u", "password": "secret", "driver": "some.Driver"}, connections=4
)


@pytest.fixture
def no_database(monkeypatch):
    """Writes go nowhere; returns the options and modes of each write."""
    writes = []

    def options(self, **values):
        if "dbtable" in values:
            writes.append(values)
        return self

    plain_save = DataFrameWriter.save

    def save(self, *args, **kwargs):
        plain_save(self.format("noop").mode("overwrite"))

    monkeypatch.setattr(DataFrameWriter, "options", options)
    monkeypatch.setattr(DataFrameWriter, "save", save)
    return writes


def test_database_options():
    assert TARGET.writer_options("t") == {
        "url": "jdbc:some:db",
        "dbtable": "t",
        "user": "u",
        "password": "secret",
        "driver": "some.Driver",
        "numPartitions": "4",
        "batchsize": "10000",
    }
    assert "secret" not in repr(TARGET)


def test_table_is_written_again_until_it_is_whole(spark, no_database, monkeypatch):
    stored = iter([12, 10])
    monkeypatch.setattr(database, "_stored_rows", lambda *_: next(stored))
    assert write_table(spark.range(10), "t", TARGET) == 10
    assert [w["dbtable"] for w in no_database] == ["t", "t"]


def test_table_that_never_fits_is_an_error(spark, no_database, monkeypatch):
    monkeypatch.setattr(database, "_stored_rows", lambda *_: 0)
    with pytest.raises(RuntimeError, match="after 2 writes"):
        write_table(spark.range(3), "t", TARGET, attempts=2)


@pytest.fixture(scope="module")
def source(spark):
    queries.wire(spark, SF_DIR)
    return queries._stored[(spark.sparkContext.applicationId, SF_DIR, "wire")]


@pytest.mark.parametrize("gold_from", ["bronze", "silver"])
def test_publish(spark, source, tmp_path, gold_from, no_database, monkeypatch):
    layers = publish(spark, source, str(tmp_path / "run"), AS_OF, (1998, 3), gold_from)
    rows = layers[gold_from]
    assert layers["claim_policy"].count() == rows.count()
    assert layers["claim_policy"].columns[0] == "policy_id"
    assert layers["march_data"].collect() == monthly_slice(rows, 1998, 3).collect()
    assert layers.city.exceptAll(distribution(rows, "city")).count() == 0
    assert layers.total_customers.first()[0] == rows.select("customer_code").distinct().count()
    assert layers.monthly.count() > 12
    no_plain = {"pan_number", "aadhaar_number"}
    assert not any(no_plain & set(df.columns) for df in layers.stored.values())

    export_csv(layers, str(tmp_path / "csv"))
    assert len(part_files(tmp_path / "csv/gold/age_group")) == 1
    for directory in ("bronze", "silver", "gold/claim_policy", "gold/march_data"):
        assert part_files(tmp_path / "csv" / directory)

    counts = {table: layers[name].count() for name, table in DATABASE.items()}
    monkeypatch.setattr(database, "_stored_rows", lambda df, table, target: counts[table])
    assert export_database(layers, TARGET) == counts


DATABASE = {
    "bronze": "InsuranceTransactions",
    "claim_policy": "transformed_df",
    "age_group": "age_group_distribution",
    "acquisition_channel": "acquisition_channel_distribution",
    "march_data": "march_data",
}


def test_publish_rejects_other_sources(spark, source, tmp_path):
    with pytest.raises(ValueError, match="gold_from"):
        publish(spark, source, str(tmp_path), gold_from="tin")


def stored_bytes(path):
    return sum(p.stat().st_size for p in pathlib.Path(path).rglob("part-*"))


def test_wire_lines_are_stored_packed_and_in_files_of_few_rows(spark):
    queries.wire(spark, SF_DIR)
    queries.field_drift(spark, SF_DIR)
    for name in ("wire", "odd_lines"):
        path = queries._once(spark, SF_DIR, name, None)
        text = sum(len(row.value) + 1 for row in spark.read.text(path).collect())
        assert stored_bytes(path) < text / 4
    assert queries.PACKED_LINES["maxRecordsPerFile"] <= 1_000_000


def test_layers_spend_less_on_digests_than_their_digits(spark, tmp_path):
    path = str(tmp_path / "layer")
    write_layer(spark.range(20_000, numPartitions=2).selectExpr("sha2(string(id), 256) AS digest"), path)
    assert stored_bytes(path) < 20_000 * 45
    write_months(spark.range(20_000).selectExpr("sha2(string(id), 256) AS digest", "date'2024-01-01' AS sale_day"), path)
    assert stored_bytes(path) < 20_000 * 45


def test_packed_csv_is_smaller_and_reads_the_same(spark, tmp_path):
    rows = queries.bronze_layer(spark, SF_DIR)
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    write_csv(rows, plain)
    write_csv(rows, packed, packed=True)
    assert stored_bytes(packed) < stored_bytes(plain) / 3
    assert all(p.name.endswith(".csv") for p in part_files(plain))
    back = read_csv(spark, packed, rows.schema)
    assert back.exceptAll(read_csv(spark, plain, rows.schema)).count() == 0 and back.count() == rows.count()
