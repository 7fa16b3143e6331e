"""A whole run from the command line, for ``spark-submit run.py SOURCE TARGET``.

Session settings, credentials and the folder in ``spark.checkpoint.dir`` come
from the deployment. The database export needs the caller's options and is
called from Python: ``plans.export_database``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from claimstrata.plans import Layers, export_csv, export_csv_version, publish
from claimstrata.session import settings_for, source_bytes
from claimstrata.sources import read_documents


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("source", help="JSON lines: a file, a folder or a pattern")
    parser.add_argument("target", help="folder of the layers")
    parser.add_argument("--csv", help="folder of the CSV exports, another than the target")
    parser.add_argument(
        "--as-of", type=dt.date.fromisoformat, help="load day, by default the current one"
    )
    parser.add_argument("--month", default="2023-03", help="sale month of the slice, as yyyy-mm")
    parser.add_argument("--gold-from", choices=("bronze", "silver"), default="bronze")
    parser.add_argument(
        "--csv-version", help="folder in which the CSV exports become a new version, seen whole or not at all"
    )
    parser.add_argument(
        "--checked", action="store_true", help="store lines that do not fit the schema beside the documents"
    )
    parser.add_argument("--input-bytes", type=int, help="size of the source, by default that of its files")
    return parser.parse_args(arguments)


def run(spark: SparkSession, options: argparse.Namespace) -> Layers:
    size = options.input_bytes
    if size is None:
        size = source_bytes(read_documents(spark, options.source))
    for key, value in settings_for(size).items():
        spark.conf.set(key, value)
    year, month = map(int, options.month.split("-"))
    layers = publish(
        spark, options.source, options.target, options.as_of, (year, month), options.gold_from, options.checked
    )
    if options.csv:
        export_csv(layers, options.csv)
    if options.csv_version:
        export_csv_version(layers, options.csv_version)
    return layers


def main() -> None:
    spark = SparkSession.builder.appName("claimstrata").getOrCreate()
    layers = run(spark, parse())
    for frame in (
        layers.total_customers,
        layers["age_group"],
        layers["acquisition_channel"],
        layers.city,
        layers["march_data"],
    ):
        frame.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
