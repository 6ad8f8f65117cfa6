"""Command line: build the star and publish it as one version (see ``landfall.plans.publish``).

    spark-submit --py-files landfall.zip landfall/__main__.py \\
        --airports-csv s3a://bucket/raw/airports.csv \\
        --demographics-csv s3a://bucket/raw/city_demographics.csv \\
        --country-list s3a://bucket/raw/lists/countries.txt \\
        --port-list s3a://bucket/raw/lists/ports.txt \\
        --state-list s3a://bucket/raw/lists/states.txt \\
        --mode-list s3a://bucket/raw/lists/modes.txt \\
        --admissions s3a://bucket/raw/admissions/ --admissions-format parquet \\
        --out s3a://bucket/star/

Credentials and file-system settings come from the Spark/Hadoop
configuration (``spark.hadoop.fs.s3a.*``), not from this program.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from landfall.contracts import fact_columns

from landfall.plans.star import (
    StarInputs,
    TABLE_PATHS,
    file_report,
    observed_report,
    publish_star,
    published_key_report,
)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="landfall", description=__doc__.split("\n\n")[0])
    p.add_argument("--airports-csv", required=True)
    p.add_argument("--demographics-csv", required=True)
    p.add_argument("--country-list", required=True)
    p.add_argument("--port-list", required=True)
    p.add_argument("--state-list", required=True)
    p.add_argument("--admissions", required=True)
    p.add_argument("--admissions-format", default="parquet")
    p.add_argument("--admissions-option", action="append", default=[], metavar="KEY=VALUE",
                   help="option of the admissions reader (may be repeated)")
    p.add_argument("--admissions-columns", help="comma-separated columns of a source narrower than the contract")
    p.add_argument("--mode-list")
    p.add_argument("--visa-list")
    p.add_argument("--out", required=True)
    p.add_argument("--report", action="store_true", help="print drop reasons, rows and nulls, types of all files and keys of the outputs")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("landfall-star").getOrCreate()
    inputs = StarInputs(
        airports_csv=a.airports_csv, demographics_csv=a.demographics_csv,
        country_list=a.country_list, port_list=a.port_list, state_list=a.state_list,
        admissions=a.admissions, admissions_format=a.admissions_format,
        mode_list=a.mode_list, visa_list=a.visa_list,
        admissions_options=dict(x.split("=", 1) for x in a.admissions_option),
        admissions_columns=a.admissions_columns.split(",") if a.admissions_columns else None,
    )
    done = publish_star(spark, inputs, a.out)
    uris = {table: done.uri(a.out, table) for table in TABLE_PATHS}
    print(json.dumps(uris))
    if a.report:
        fact = None if inputs.admissions_columns is None else fact_columns(inputs.admissions_columns)
        # counted while writing; footers; key columns of the published tables: the inputs are not read again
        for report in (observed_report(spark, done), file_report(spark, a.out, done), published_key_report(spark, uris, {}, fact)):
            for r in report.collect():  # a few rows per table
                print(json.dumps(r.asDict()))


if __name__ == "__main__":
    main()
