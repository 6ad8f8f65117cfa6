"""The full star build: five dimensions and three layouts of the admissions
fact, written as partitioned Parquet under one output URI.

Every input and the output base are URIs (local, HDFS, S3 via ``s3a://``,
...); executors read and write them directly, nothing passes through the
driver. The fact is computed once: the first layout is written from the
computed fact, and the other two layouts are written from that written
table (read back with its contract). This cuts the lineage (a lost executor
never forces the de-duplication shuffle to be recomputed) and needs no
cache of the whole fact.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.contracts import (
    AIRPORT_COLUMNS,
    AIRPORTS,
    COUNTRY,
    DEMOGRAPHICS,
    DEMOGRAPHICS_KEY,
    FACT_KEY,
    FACT_LAYOUTS,
    LAYOUTS,
    PORT,
    STATE,
    fact_schema,
)
from landfall.operators.footers import file_type_report
from landfall.operators.quality import drop_reasons, key_report, schema_report
from landfall.plans import dims
from landfall.plans.fact import FactCounts, admissions
from landfall.plans.marts import read_mart, write_mart
from landfall.plans.publish import Manifest, Publication
from landfall.sources.admissions import load_raw_admissions
from landfall.sources.constants import values_frame
from landfall.sources.codelists import read_country, read_mode, read_port, read_state, read_visa
from landfall.sources.delimited import read_delimited

# Relative location of each published table under the output base.
TABLE_PATHS = {
    "airports": "airports/airports.parquet",
    "demographics": "demographics/demographics.parquet",
    "country": "country/country.parquet",
    "portOfEntry": "portOfEntry/portOfEntry.parquet",
    "state": "state/state.parquet",
    "visatype": "visatype/visatype.parquet",
    "arrival_date": "arrival_date/poe.parquet",
    "citizenship": "citizenship/citizenship.parquet",
}

# Key of each published table (for the key report).
TABLE_KEYS = {
    "airports": ["port_code"],
    "demographics": DEMOGRAPHICS_KEY,
    "country": ["country_code"],
    "portOfEntry": ["port_of_entry"],
    "state": ["state_code"],
    "visatype": FACT_KEY,
    "arrival_date": FACT_KEY,
    "citizenship": FACT_KEY,
}

# Contract of each published dimension; the fact's is ``fact_schema``.
TABLE_CONTRACTS = {"airports": AIRPORTS, "demographics": DEMOGRAPHICS, "country": COUNTRY,
                   "portOfEntry": PORT, "state": STATE}


@dataclass
class StarInputs:
    """Locations of the raw inputs."""
    airports_csv: str
    demographics_csv: str
    country_list: str
    port_list: str
    state_list: str
    admissions: str
    admissions_format: str = "parquet"
    mode_list: str | None = None   # default: the dictionary's four modes
    visa_list: str | None = None   # default: the dictionary's three visa categories
    admissions_options: dict[str, str] = field(default_factory=dict)
    admissions_columns: list[str] | None = None  # default: the whole contract


def table_uri(out: str, table: str) -> str:
    return f"{out.rstrip('/')}/{TABLE_PATHS[table]}"


def airports_dimension(spark: SparkSession, airports_csv: str) -> DataFrame:
    """Airport-codes CSV -> airport dimension (lazy)."""
    raw = read_delimited(spark, airports_csv, sep=",", header=True,
                         required=["ident", "iso_country", "iso_region", "iata_code", "local_code"])
    return dims.airports(raw.select(*[c for c in AIRPORT_COLUMNS if c in raw.columns]))


def demographics_dimension(spark: SparkSession, demographics_csv: str) -> DataFrame:
    """City-demographics CSV -> demographics dimension (lazy)."""
    demo = read_delimited(spark, demographics_csv, sep=";", header=True, schema=DEMOGRAPHICS)
    return dims.demographics(demo)


def build_fact(spark: SparkSession, inp: StarInputs, counts: FactCounts | None = None) -> DataFrame:
    """The admissions fact. Lazy but for the size check of each list file."""
    built_in = inp.mode_list is None and inp.visa_list is None
    return admissions(raw_admissions(spark, inp), read_mode(spark, inp.mode_list),
                      read_visa(spark, inp.visa_list), lookups_bounded=built_in, lookups_unique=True, counts=counts)


def raw_admissions(spark: SparkSession, inp: StarInputs) -> DataFrame:
    """The raw admissions of the inputs (lazy)."""
    return load_raw_admissions(spark, inp.admissions, inp.admissions_format,
                               columns=inp.admissions_columns, options=inp.admissions_options)


# ------------------------------------------------------------ one job per table
def _publish(df: DataFrame, out: str, table: str) -> str:
    """Write a dimension in its layout."""
    uri = table_uri(out, table)
    write_mart(df, uri, LAYOUTS[table])
    return uri


def publish_airports(spark: SparkSession, airports_csv: str, out: str) -> str:
    """Airport-codes CSV -> ``airports`` by state; returns its URI."""
    return _publish(airports_dimension(spark, airports_csv), out, "airports")


def publish_demographics(spark: SparkSession, demographics_csv: str, out: str) -> str:
    """City-demographics CSV -> ``demographics`` by State, City."""
    return _publish(demographics_dimension(spark, demographics_csv), out, "demographics")


def publish_country(spark: SparkSession, country_list: str, out: str) -> str:
    """Country list -> ``country`` by country."""
    return _publish(read_country(spark, country_list), out, "country")


def publish_ports(spark: SparkSession, port_list: str, out: str) -> str:
    """Port list -> ``portOfEntry`` by city."""
    return _publish(read_port(spark, port_list), out, "portOfEntry")


def publish_states(spark: SparkSession, state_list: str, out: str) -> str:
    """State list -> ``state`` by state."""
    return _publish(read_state(spark, state_list), out, "state")


def publish_admissions(spark: SparkSession, admissions: str, out: str, fmt: str = "parquet",
                       mode_list: str | None = None, visa_list: str | None = None,
                       options: dict[str, str] | None = None,
                       columns: list[str] | None = None) -> dict[str, str]:
    """Raw admissions -> the three fact layouts; returns layout -> URI."""
    inp = StarInputs("", "", "", "", "", admissions, fmt, mode_list, visa_list, dict(options or {}), columns)
    return publish_fact(spark, build_fact(spark, inp), out)


def publish_fact(spark: SparkSession, fact: DataFrame, out: str,
                 parallel_jobs: int = 2) -> dict[str, str]:
    """Write the three fact layouts; the first is computed, the other two are
    re-partitioned from the first written table (as concurrent jobs)."""
    first, *others = FACT_LAYOUTS
    uris = {first: table_uri(out, first)}
    write_mart(fact, uris[first], LAYOUTS[first])
    written = read_mart(spark, uris[first], fact_schema(fact.columns))
    uris.update({layout: table_uri(out, layout) for layout in others})
    with ThreadPoolExecutor(max(parallel_jobs, 1)) as pool:
        for f in [pool.submit(write_mart, written, uris[layout], LAYOUTS[layout])
                  for layout in others]:
            f.result()
    return uris


def _fact_layouts(publication: Publication, spark: SparkSession, inp: StarInputs, parallel_jobs: int) -> None:
    """The three layouts of one version: the first is computed and counted, the
    others are written from it."""
    counts = FactCounts()
    first, *others = FACT_LAYOUTS
    fact = build_fact(spark, inp, counts)
    uri = publication.write(fact, first, TABLE_PATHS[first], LAYOUTS[first])
    publication.facts.update(counts.reasons())
    written = read_mart(spark, uri, fact_schema(fact.columns))
    with ThreadPoolExecutor(max(parallel_jobs, 1)) as pool:
        for f in [pool.submit(publication.write, written, layout, TABLE_PATHS[layout], LAYOUTS[layout]) for layout in others]:
            f.result()


def publish_star(spark: SparkSession, inp: StarInputs, out: str, parallel_jobs: int = 4) -> Manifest:
    """Build all eight tables as one version below ``out`` and publish them
    together, or not at all (see ``landfall.plans.publish``).

    The five dimension writes and the fact chain are independent Spark jobs
    and are submitted concurrently (the small dimension jobs fill the
    cluster while the fact is shuffled); any failure is raised and leaves the
    star published before as it is. The manifest also keeps the drop reasons,
    counted while the fact was computed.
    """
    dimensions = {
        "airports": lambda: airports_dimension(spark, inp.airports_csv),
        "demographics": lambda: demographics_dimension(spark, inp.demographics_csv),
        "country": lambda: read_country(spark, inp.country_list),
        "portOfEntry": lambda: read_port(spark, inp.port_list),
        "state": lambda: read_state(spark, inp.state_list),
    }
    publication = Publication(spark, out)
    with ThreadPoolExecutor(max(parallel_jobs, 1)) as pool:
        jobs = [pool.submit(_fact_layouts, publication, spark, inp, parallel_jobs)]
        jobs += [pool.submit(lambda n=name, df=df: publication.write(df(), n, TABLE_PATHS[n], LAYOUTS[n]))
                 for name, df in dimensions.items()]
        for job in jobs:
            job.result()
    return publication.commit(same_rows=FACT_LAYOUTS)


def run(spark: SparkSession, inp: StarInputs, out: str, parallel_jobs: int = 4) -> dict[str, str]:
    """:func:`publish_star`; returns table -> URI."""
    done = publish_star(spark, inp, out, parallel_jobs)
    return {table: done.uri(out, table) for table in TABLE_PATHS}


def observed_report(spark: SparkSession, done: Manifest) -> DataFrame:
    """What was counted while a star was written: ``table_name, metric, value``
    with the rows and the nulls per column of every table, and the fact's drop
    reasons (table ``admissions``). Reads neither inputs nor tables."""
    rows = [("admissions", reason, n) for reason, n in done.facts.items()]
    for name, t in done.tables.items():
        rows += [(name, "rows", t.row_count), *((name, f"nulls:{c}", n) for c, n in t.nulls.items())]
    return values_frame(spark, rows, T.StructType([
        T.StructField("table_name", T.StringType()), T.StructField("metric", T.StringType()),
        T.StructField("value", T.LongType())]))


def file_report(spark: SparkSession, out: str, done: Manifest) -> DataFrame:
    """Types of every file of a published star against the contracts:
    ``table_name`` and the columns of ``file_type_report``. Reads footers only."""
    reports = []
    for name, t in done.tables.items():
        contract = TABLE_CONTRACTS.get(name) or fact_schema([c for c, _ in t.columns])
        report = file_type_report(spark, done.uri(out, name), contract, tuple(t.partition_columns))
        reports.append(report.select(F.lit(name).alias("table_name"), "*"))
    return _stacked(reports)


def read_published(spark: SparkSession, table: str, uri: str,
                   fact_columns: list[str] | None = None) -> DataFrame:
    """A published table with its contract: partition values are parsed as the
    contract's types, never inferred."""
    return read_mart(spark, uri, TABLE_CONTRACTS.get(table) or fact_schema(fact_columns))


def _stacked(reports: list[DataFrame]) -> DataFrame:
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def published_key_report(spark: SparkSession, uris: dict[str, str],
                         min_rows: dict[str, int] | None = None,
                         fact_columns: list[str] | None = None) -> DataFrame:
    """Rows, null keys and duplicate keys of every published table (read
    back); with ``min_rows`` (table -> minimum, default 1) also whether each
    table holds enough rows."""
    return _stacked([key_report(read_published(spark, name, uri, fact_columns), name, TABLE_KEYS[name],
                                None if min_rows is None else min_rows.get(name, 1))
                     for name, uri in uris.items()])


def published_schema_report(spark: SparkSession, uris: dict[str, str],
                            fact_columns: list[str] | None = None) -> DataFrame:
    """Column types against the contract and null counts of every published
    table: ``table_name`` and the columns of ``schema_report``. Types are those
    of the files for stored columns, the contract's for partition columns."""
    reports = []
    for name, uri in uris.items():
        contract = TABLE_CONTRACTS.get(name) or fact_schema(fact_columns)
        files = spark.read.parquet(uri).schema
        stored = {f.name: f.dataType.simpleString() for f in files.fields if f.name not in LAYOUTS[name]}
        table = read_published(spark, name, uri, fact_columns)
        reports.append(schema_report(table, contract, stored).withColumn("table_name", F.lit(name)))
    return _stacked(reports)


def admissions_drop_reasons(spark: SparkSession, inp: StarInputs) -> DataFrame:
    """Where the raw admission rows of the inputs go, per cleaning rule."""
    return drop_reasons(raw_admissions(spark, inp))
