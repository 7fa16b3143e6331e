import datetime as dt
import pathlib

from claimstrata.registry import queries
from claimstrata.session import settings_for
from run import parse, run

SF_DIR = "/root/testdata/sf0.001"


def test_command_line(spark, settings, tmp_path):
    queries.wire(spark, SF_DIR)
    source = queries._stored[(spark.sparkContext.applicationId, SF_DIR, "wire")]
    options = parse(
        [source, f"{tmp_path}/layers", "--csv", f"{tmp_path}/csv", "--as-of", "2024-07-01"]
        + ["--month", "1998-03", "--input-bytes", "5000000"]
    )
    with settings(settings_for(1)):
        layers = run(spark, options)
        assert layers["silver"].first().etl_date == "01-07-2024"
        assert [(r.year, r.month) for r in layers["march_data"].collect()] == [(1998, 3)]
        assert (pathlib.Path(tmp_path) / "csv/gold/march_data/_SUCCESS").exists()


def test_defaults():
    options = parse(["in", "out"])
    assert (options.month, options.gold_from, options.as_of) == ("2023-03", "bronze", None)
    assert parse(["i", "o", "--as-of", "2023-03-05"]).as_of == dt.date(2023, 3, 5)
