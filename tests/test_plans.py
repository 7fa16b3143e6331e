"""What the physical plans must and must not contain."""

import pytest

from claimstrata.operators.policies import split_limit
from claimstrata.registry import queries
from claimstrata.session import scan_splits, settings_for, shuffle_partitions, source_bytes

SF_DIR = "/root/testdata/sf0.001"
EAGER = {"checkpoint_bronze", "csv_roundtrip", "csv_rows", "csv_version", "published_rows"}
EAGER |= {name for name in queries.QUERIES if name.startswith("published_")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - EAGER))
def test_no_python_cross_join_or_single_task_shuffle(spark, name):
    text = plan(queries.QUERIES[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin", "Window"):
        assert word not in text
    # Only the partial counts of the customers meet in one task.
    assert text.count("SinglePartition") == (name in ("total_customers", "customers_merged"))


def test_bronze_is_one_stage_without_shuffle(spark):
    text = plan(queries.bronze(spark, SF_DIR))
    assert "Exchange" not in text and text.count("FileScan") == 1
    # The hash of identity fields stands below the explode, once per document.
    assert text.index("Generate explode") < text.index("sha2(")


def test_metrics_read_two_columns_and_shuffle_once(spark):
    text = plan(queries.policy_metrics(spark, SF_DIR))
    assert text.count("Exchange") == 1
    assert "ReadSchema: struct<policy_id:string,claims:array<int>>" in text


def test_single_metric_reads_only_its_columns(spark):
    text = plan(queries.QUERIES["policy_total_claims"](spark, SF_DIR))
    assert "ReadSchema: struct<policy_id:string,claims:array<int>>" in text
    assert "sum(" not in text


def test_slice_filter_reaches_the_reader(spark):
    text = plan(queries.monthly_slice(spark, SF_DIR))
    assert "GreaterThanOrEqual(sale_day,1998-03-01), LessThan(sale_day,1998-04-01)" in text
    assert (
        "ReadSchema: struct<customer_code:int,claims:array<int>,revenue_amt:int,sale_day:date>"
        in text
    )


def test_small_metrics_are_joined_without_shuffling_rows(spark):
    text = plan(queries.enrich_policy_metrics(spark, SF_DIR))
    assert "hashpartitioning" not in text


def test_large_metrics_shuffle_each_side_once(spark, settings):
    with settings({"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(queries.enrich_policy_metrics(spark, SF_DIR))
    assert text.count("hashpartitioning(policy_id") == 2
    assert text.index("Generate explode(claims") < text.index("SortMergeJoin")


def test_stamp_stays_out_of_the_shuffle(spark):
    text = plan(queries.silver(spark, SF_DIR))
    assert text.count("Exchange") == 1
    assert "etl_date" not in text[text.index("Exchange") :]


def test_settings_grow_with_the_data():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert settings_for(0)[key] == "200"
    assert settings_for(100 * 1024**4)[key] == str(100 * 1024 // 2)


def test_slices_follow_the_settings_of_a_large_run(spark, settings):
    metrics = spark.createDataFrame(
        [("hot", 40_000_000_000), ("other", 1), (None, 60_000_000_000)], "policy_id string, total_claims long"
    )
    with settings(settings_for(100 * 1024**4)):
        assert shuffle_partitions(spark) == 100 * 1024 // 2
        limit, largest = split_limit(metrics, floor=1)
    # An eighth of an average partition's claims, however many partitions the session has without a run.
    assert limit == -(-100_000_000_001 // (8 * 51_200)) and largest == 40_000_000_000
    with settings({"spark.sql.shuffle.partitions": "16"}):
        assert split_limit(metrics, floor=1)[0] == -(-100_000_000_001 // (8 * 16))


def test_scan_splits_are_put_back(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), scan_splits(spark, 1024):
        assert spark.conf.get(key) == "1024"
        with scan_splits(spark, 1024**3):  # does not raise what the deployment has
            assert spark.conf.get(key) == "1024"
        raise ValueError
    assert spark.conf.get(key) == before


def test_shuffle_follows_the_source(spark, tmp_path):
    for rows in (10, 1000):
        spark.range(rows).write.json(str(tmp_path / str(rows)))
    small, large = (source_bytes(spark.read.json(str(tmp_path / str(n)))) for n in (10, 1000))
    assert 0 < small < large


def test_large_metrics_are_joined_without_sorting_under_the_settings(spark, settings):
    with settings({**settings_for(1), "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        rows = queries.enrich_policy_metrics(spark, SF_DIR)
        sums = rows.selectExpr("sum(total_claims) t", "sum(claim_amount) c", "max(sale_id) s")
        sums.collect()
        final = plan(sums).split("Initial Plan")[0]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final
