"""The pipeline as ``spark-submit`` jobs.

    spark-submit --py-files bronzeway.zip bronzeway/jobs.py bronze  RAW_FOLDER BRONZE [--only-new]
    spark-submit --py-files bronzeway.zip bronzeway/jobs.py refresh RAW_FOLDER LAKE [--fidelity clean]
    spark-submit --py-files bronzeway.zip bronzeway/jobs.py silver  BRONZE SILVER [--fidelity clean]
    spark-submit --py-files bronzeway.zip bronzeway/jobs.py gold    SILVER GOLD
    spark-submit --py-files bronzeway.zip bronzeway/jobs.py yearly  GOLD OUT
    spark-submit --py-files bronzeway.zip bronzeway/jobs.py profile RAW_FOLDER OUT
    spark-submit --py-files bronzeway.zip bronzeway/jobs.py sample  BRONZE OUT
    spark-submit --py-files bronzeway.zip bronzeway/jobs.py columns RAW_FOLDER OUT
    spark-submit --py-files bronzeway.zip bronzeway/jobs.py report  GOLD OUT
        --highways GEOJSON --states TOPOJSON [--years 2015 2020] [--select SP MG]

Paths may be object-store URIs; the connector's options go to ``spark-submit``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from bronzeway import values as v
from bronzeway.operators.schema import column_presence, common_columns
from bronzeway.plans import accidents, incremental
from bronzeway.session import make_session
from bronzeway.sources.bronze import read_bronze, sample_bronze
from bronzeway.sources.files import list_source_files, read_drifting_csv, read_headers
from bronzeway.sources.geo import read_geojson, read_topojson_attributes
from bronzeway.sources.tables import cached, read_table, write_table


def _paths(spark: SparkSession, folder: str) -> list[str]:
    return [row.path for row in list_source_files(spark, folder).collect()]


def _profile(raw: DataFrame, out: str) -> None:
    with cached(raw.select(*{*v.FORMAT_PROFILE_COLUMNS, *v.VALUE_PROFILE_COLUMNS})) as kept:
        write_table(accidents.format_profile(kept), f"{out}/formats")
        write_table(accidents.value_profile(kept), f"{out}/values")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "bronze":
        accidents.load_raw(spark, args.source, args.target, args.only_new)
    elif args.job == "refresh":
        incremental.refresh(spark, args.source, args.target, args.fidelity)
    elif args.job == "silver":
        bronze = read_bronze(spark, args.source, columns=v.SILVER_SOURCE_COLUMNS)
        write_table(accidents.to_silver(bronze, args.fidelity), args.target)
    elif args.job == "gold":
        gold = accidents.to_gold(read_table(spark, args.source))
        write_table(gold, args.target, cluster_by=["DATA"])
    elif args.job == "yearly":
        write_table(accidents.yearly_check(read_table(spark, args.source)), args.target)
    elif args.job == "profile":
        _profile(read_drifting_csv(spark, _paths(spark, args.source)), args.target)
    elif args.job == "sample":
        sample = sample_bronze(spark, args.source, v.SAMPLE_FRACTION, v.SAMPLE_SEED)
        write_table(sample, args.target)
    elif args.job == "columns":
        headers = read_headers(spark, _paths(spark, args.source))
        per_file = [(f, i, c) for f, names in headers.items() for i, c in enumerate(names, 1)]
        listed = spark.createDataFrame(per_file, "source string, position int, column string")
        write_table(listed, f"{args.target}/files")
        write_table(column_presence(spark, headers), f"{args.target}/counts")
        write_table(common_columns(spark, headers), f"{args.target}/common")
    elif args.job == "report":
        with cached(read_table(spark, args.source)) as gold:
            shown = accidents.report(
                gold,
                read_geojson(spark, args.highways),
                read_topojson_attributes(spark, args.states),
                years=tuple(args.years) if args.years else None,
                states=args.select,
            )
            write_table(shown, args.target)


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="bronzeway")
    parser.add_argument(
        "job",
        choices=["bronze", "refresh", "silver", "gold", "yearly", "profile", "sample", "columns", "report"],
    )
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--only-new", action="store_true")
    parser.add_argument(
        "--fidelity",
        default=accidents.REFERENCE,
        choices=[accidents.REFERENCE, accidents.CLEAN],
    )
    parser.add_argument("--highways")
    parser.add_argument("--states")
    parser.add_argument("--years", nargs=2, type=int)
    parser.add_argument("--select", nargs="*", default=[], help="states")
    return parser.parse_args(argv)


if __name__ == "__main__":
    run(make_session(), parse())
