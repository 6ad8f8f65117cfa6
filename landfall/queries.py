"""Registered queries: one per operator of the inventory, each with its
DuckDB oracle SQL over the same generated tables.

Every query reads whole tables (no id subsets or row caps); modular
arithmetic on keys only *derives* edge values (see ``landfall.fixtures``).
Intermediate files (CSV/text/Parquet written to exercise a source or a
mart) go to fresh locations under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import fixtures as fx
from landfall.contracts import (
    AIRPORT_COLUMNS,
    AIRPORTS,
    COUNTRY,
    DEMOGRAPHICS,
    LAYOUTS,
    PORT,
    STATE,
    fact_schema,
)
from landfall.fixtures_sas import write_sas
from landfall.functions.cleaning import (
    admitted_until,
    region_state,
    sas_day_to_date,
    strip_nonword,
    to_number,
)
from landfall.operators.fingerprint import compare_tables
from landfall.operators.footers import file_type_report
from landfall.operators.quality import drop_reasons, key_report, schema_report
from landfall.operators.relational import keep_first, keep_first_sieved, label_or_other, lookup_left, salted_lookup_left
from landfall.plans import dims
from landfall.plans.fact import admissions, cast_raw
from landfall.plans import publish, star
from landfall.plans.marts import read_mart, write_mart
from landfall.session import distinguish_case, scratch_uri
from landfall.sources.admissions import load_raw_admissions
from landfall.sources.codelists import (
    default_mode,
    default_visa,
    read_country,
    read_mode,
    read_port,
    read_state,
    read_visa,
)
from landfall.sources.constants import values_frame
from landfall.sources.delimited import read_delimited
from landfall.sources.dictionary import read_dictionary
from landfall.sources.rejects import read_with_rejects, reject_report

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# ------------------------------------------------------------------ oracle CTEs
# The fact keeps the first record of a key by all raw columns in contract order.
_SLIM = ["i94yr", "i94mon", "i94cit", "arrdate", "i94mode", "depdate", "i94visa", "allowed", "visatype"]
_FULL = ["i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr", "depdate", "i94bir",
         "i94visa", "visapost", "biryear", "allowed", "gender", "airline", "admnum", "fltno", "visatype"]
_ORDER_SLIM, _ORDER_FULL = (", ".join(f"{c} NULLS FIRST" for c in x) for x in (_SLIM, _FULL))

RAW_ADMISSIONS_CTE = """raw_admissions AS (
 SELECT CASE WHEN v.v = 3 THEN 'nan'::DOUBLE WHEN v.v <> 2 THEN CAST(o.o_orderkey AS DOUBLE) END AS cicid,
  CAST(year(o.o_orderdate) AS DOUBLE) AS i94yr, CAST(month(o.o_orderdate) AS DOUBLE) AS i94mon,
  CAST(c.c_nationkey AS DOUBLE) AS i94cit,
  CAST(CAST(o.o_orderdate AS DATE) - DATE '1960-01-01' + (v.v = 1)::INT AS DOUBLE) AS arrdate,
  CASE o.o_orderkey % 6 WHEN 0 THEN 1e0 WHEN 1 THEN 2e0 WHEN 2 THEN 3e0 WHEN 3 THEN 9e0 WHEN 4 THEN 7e0 END AS i94mode,
  CASE WHEN v.v = 4 THEN 'nan'::DOUBLE WHEN o.o_orderkey % 10 <> 0 THEN CAST(CAST(o.o_orderdate AS DATE) - DATE '1960-01-01' + (v.v = 1)::INT + o.o_orderkey % 30 AS DOUBLE) END AS depdate,
  CAST(1 + o.o_orderkey % 4 AS DOUBLE) AS i94visa,
  CASE WHEN o.o_orderkey % 11 = 0 THEN 'D/S' WHEN o.o_orderkey % 13 = 0 THEN strftime(o.o_orderdate, '%m/%d/%Y')
       WHEN o.o_orderkey % 17 = 0 THEN '99999999' WHEN o.o_orderkey % 19 = 0 THEN NULL
       ELSE strftime(o.o_orderdate, '%m%d%Y') END AS dtaddto,
  o.o_orderstatus AS visatype
 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN (VALUES (0),(1),(2),(3),(4)) v(v) ON v.v = 0 OR (v.v = 1 AND o.o_orderkey % 7 = 0) OR (v.v = 2 AND o.o_orderkey % 35 = 0)
   OR (v.v = 3 AND o.o_orderkey % 49 = 0) OR (v.v = 4 AND o.o_orderkey % 77 = 1))"""

RAW_AIRPORTS_CTE = """raw_airports AS (
 SELECT c_name AS ident, CASE WHEN c_nationkey % 2 = 0 THEN 'US' ELSE 'CA' END AS iso_country,
  CASE WHEN c_custkey % 9 = 0 THEN 'US' ELSE 'US-' || c_mktsegment END AS iso_region,
  CASE WHEN c_custkey % 3 = 0 THEN 'P' || CAST(c_custkey % 400 AS VARCHAR) END AS iata_code,
  CASE WHEN c_custkey % 2 = 0 THEN 'P' || CAST(c_custkey % 500 AS VARCHAR) END AS local_code
 FROM customer)"""

FACT_CTE = """clean AS (
 SELECT *, try_strptime(CASE WHEN regexp_matches(regexp_replace(dtaddto, '[^A-Za-z0-9_]+', '', 'g'), '^[0-9]{8}$')
        THEN regexp_replace(dtaddto, '[^A-Za-z0-9_]+', '', 'g') END, '%m%d%Y') AS allowed
 FROM raw_admissions WHERE TRY_CAST(depdate AS INTEGER) IS NOT NULL AND dtaddto IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY TRY_CAST(cicid AS BIGINT) ORDER BY """ + _ORDER_SLIM + """) AS rn
 FROM clean WHERE allowed IS NOT NULL AND TRY_CAST(cicid AS BIGINT) IS NOT NULL),
fact AS (
 SELECT TRY_CAST(cicid AS BIGINT) AS cic_id, CAST(i94yr AS INTEGER) AS year_of_entry, CAST(i94mon AS INTEGER) AS month_of_entry,
  CAST(i94cit AS INTEGER) AS country_of_citizenship, DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrival_date,
  m.mode AS arrival_mode, DATE '1960-01-01' + TRY_CAST(depdate AS INTEGER) AS departure_date,
  v.visa AS visa_code, CAST(allowed AS DATE) AS person_allowed_date, visatype AS visa_type
 FROM ranked LEFT JOIN (VALUES (1,'Business'),(2,'Pleasure'),(3,'Student')) v(code, visa) ON CAST(i94visa AS INTEGER) = v.code
  LEFT JOIN (VALUES (1,'Air'),(2,'Sea'),(3,'Land'),(9,'Not reported')) m(code, mode) ON CAST(i94mode AS INTEGER) = m.code
 WHERE rn = 1)"""

RAW_ADMISSIONS_FULL_CTE = """raw_admissions_full AS (
 SELECT CASE WHEN v.v = 3 THEN 'nan'::DOUBLE WHEN v.v <> 2 THEN CAST(o.o_orderkey AS DOUBLE) END AS cicid,
  CAST(year(o.o_orderdate) AS DOUBLE) AS i94yr, CAST(month(o.o_orderdate) AS DOUBLE) AS i94mon,
  CAST(c.c_nationkey AS DOUBLE) AS i94cit, CAST((c.c_nationkey + 1) % 25 AS DOUBLE) AS i94res,
  'P' || CAST(o.o_orderkey % 300 AS VARCHAR) AS i94port,
  CAST(CAST(o.o_orderdate AS DATE) - DATE '1960-01-01' + (v.v = 1)::INT AS DOUBLE) AS arrdate,
  CASE o.o_orderkey % 6 WHEN 0 THEN 1e0 WHEN 1 THEN 2e0 WHEN 2 THEN 3e0 WHEN 3 THEN 9e0 WHEN 4 THEN 7e0 END AS i94mode,
  CASE WHEN o.o_orderkey % 23 <> 0 THEN 'S' || CAST(c.c_nationkey % 5 AS VARCHAR) END AS i94addr,
  CASE WHEN v.v = 4 THEN 'nan'::DOUBLE WHEN o.o_orderkey % 10 <> 0 THEN CAST(CAST(o.o_orderdate AS DATE) - DATE '1960-01-01' + (v.v = 1)::INT + o.o_orderkey % 30 AS DOUBLE) END AS depdate,
  CAST(o.o_custkey % 90 AS DOUBLE) AS i94bir,
  CAST(1 + o.o_orderkey % 4 AS DOUBLE) AS i94visa,
  substr(o.o_orderpriority, 3, 3) AS visapost,
  CAST(year(o.o_orderdate) - o.o_custkey % 90 AS DOUBLE) AS biryear,
  CASE WHEN o.o_orderkey % 11 = 0 THEN 'D/S' WHEN o.o_orderkey % 13 = 0 THEN strftime(o.o_orderdate, '%m/%d/%Y')
       WHEN o.o_orderkey % 17 = 0 THEN '99999999' WHEN o.o_orderkey % 19 = 0 THEN NULL
       ELSE strftime(o.o_orderdate, '%m%d%Y') END AS dtaddto,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS gender,
  'A' || CAST(o.o_custkey % 40 AS VARCHAR) AS airline,
  CAST(o.o_orderkey * 1000 + 7 AS DOUBLE) AS admnum,
  CAST(o.o_orderkey % 9000 AS VARCHAR) AS fltno,
  o.o_orderstatus AS visatype
 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN (VALUES (0),(1),(2),(3),(4)) v(v) ON v.v = 0 OR (v.v = 1 AND o.o_orderkey % 7 = 0) OR (v.v = 2 AND o.o_orderkey % 35 = 0)
   OR (v.v = 3 AND o.o_orderkey % 49 = 0) OR (v.v = 4 AND o.o_orderkey % 77 = 1))"""

FACT_FULL_CTE = """clean_full AS (
 SELECT *, try_strptime(CASE WHEN regexp_matches(regexp_replace(dtaddto, '[^A-Za-z0-9_]+', '', 'g'), '^[0-9]{8}$')
        THEN regexp_replace(dtaddto, '[^A-Za-z0-9_]+', '', 'g') END, '%m%d%Y') AS allowed
 FROM raw_admissions_full WHERE TRY_CAST(depdate AS INTEGER) IS NOT NULL AND dtaddto IS NOT NULL),
ranked_full AS (SELECT *, row_number() OVER (PARTITION BY TRY_CAST(cicid AS BIGINT) ORDER BY """ + _ORDER_FULL + """) AS rn
 FROM clean_full WHERE allowed IS NOT NULL AND TRY_CAST(cicid AS BIGINT) IS NOT NULL),
fact_full AS (
 SELECT TRY_CAST(cicid AS BIGINT) AS cic_id, CAST(i94yr AS INTEGER) AS year_of_entry, CAST(i94mon AS INTEGER) AS month_of_entry,
  CAST(i94cit AS INTEGER) AS country_of_citizenship, CAST(i94res AS INTEGER) AS country_of_residence,
  i94port AS port_of_entry, DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrival_date,
  m.mode AS arrival_mode, i94addr AS us_state, DATE '1960-01-01' + TRY_CAST(depdate AS INTEGER) AS departure_date,
  CAST(i94bir AS INTEGER) AS person_age, v.visa AS visa_code, visapost AS visa_issuing_post,
  CAST(biryear AS INTEGER) AS person_birth_year, CAST(allowed AS DATE) AS person_allowed_date,
  gender, airline, CAST(admnum AS BIGINT) AS admission_number, fltno AS flight_number, visatype AS visa_type
 FROM ranked_full LEFT JOIN (VALUES (1,'Business'),(2,'Pleasure'),(3,'Student')) v(code, visa) ON CAST(i94visa AS INTEGER) = v.code
  LEFT JOIN (VALUES (1,'Air'),(2,'Sea'),(3,'Land'),(9,'Not reported')) m(code, mode) ON CAST(i94mode AS INTEGER) = m.code
 WHERE rn = 1)"""

RAW_AIRPORTS_FULL_CTE = """raw_airports_full AS (
 SELECT c_name AS ident,
  CASE c_custkey % 3 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'small_airport' ELSE 'heliport' END AS "type",
  'Airport ' || CAST(c_custkey AS VARCHAR) AS "name", CAST(c_custkey % 5000 AS VARCHAR) AS elevation_ft,
  'NA' AS continent, CASE WHEN c_nationkey % 2 = 0 THEN 'US' ELSE 'CA' END AS iso_country,
  CASE WHEN c_custkey % 9 = 0 THEN 'US' ELSE 'US-' || c_mktsegment END AS iso_region,
  'Town ' || CAST(c_nationkey AS VARCHAR) AS municipality, 'G' || CAST(c_custkey AS VARCHAR) AS gps_code,
  CASE WHEN c_custkey % 3 = 0 THEN 'P' || CAST(c_custkey % 400 AS VARCHAR) END AS iata_code,
  CASE WHEN c_custkey % 2 = 0 THEN 'P' || CAST(c_custkey % 500 AS VARCHAR) END AS local_code,
  CAST(c_custkey % 180 AS VARCHAR) || ', ' || CAST(c_nationkey AS VARCHAR) AS coordinates
 FROM customer)"""

_CTES = {"raw_admissions_full": RAW_ADMISSIONS_FULL_CTE, "raw_airports_full": RAW_AIRPORTS_FULL_CTE,
         "fact_full": FACT_FULL_CTE,
         "raw_admissions": RAW_ADMISSIONS_CTE, "raw_airports": RAW_AIRPORTS_CTE, "fact": FACT_CTE}


def _sql(text: str) -> str:
    """Substitute the CTE placeholders (and only those)."""
    for name, block in _CTES.items():
        text = text.replace("{" + name + "}", block)
    return text.strip()


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _sql(sql)
        return fn
    return register


# Columns of the narrower admissions fixture (the loader wants them named).
SLIM_COLUMNS = ["cicid", "i94yr", "i94mon", "i94cit", "arrdate", "i94mode", "depdate", "i94visa", "dtaddto", "visatype"]

# ------------------------------------------------------------------ sources
@query("src_csv_header_strings", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer
""")
def src_csv_header_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with a header, read without a schema: every column is text."""
    uri = scratch_uri(spark, "customer-csv")
    fx.table(spark, sf_dir, "customer").write.option("header", "true").csv(uri)
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    return read_delimited(spark, uri, header=True, required=cols).select(*cols)


SUPPLIER_CONTRACT = T.StructType([
    T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
    T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType()),
])


@query("src_csv_semicolon_schema", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def src_csv_semicolon_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2/P8: ';'-separated CSV whose header has other names (with blanks and
    dashes); names and types come from the contract, by position."""
    uri = scratch_uri(spark, "supplier-csv")
    s = fx.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Supplier Key"), F.col("s_name").alias("Supplier-Name"),
        F.col("s_nationkey").alias("Nation Key"), F.col("s_acctbal").alias("Account Balance"))
    s.write.option("header", "true").option("sep", ";").csv(uri)
    return read_delimited(spark, uri, sep=";", header=True, schema=SUPPLIER_CONTRACT)


@query("src_raw_admissions", """
WITH {raw_admissions} SELECT cicid, i94yr, i94mon, i94cit, arrdate, i94mode, depdate, i94visa, dtaddto, visatype FROM raw_admissions
""")
def src_raw_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw admissions through the format-agnostic loader (contract
    check plus column pruning at the scan)."""
    uri = scratch_uri(spark, "raw-admissions")
    fx.raw_admissions(spark, sf_dir).write.parquet(uri)
    return load_raw_admissions(spark, uri, "parquet", SLIM_COLUMNS)


@query("src_admissions_sas", """
WITH {raw_admissions_full}, s AS (SELECT 'plain' AS stored, * FROM raw_admissions_full UNION ALL SELECT 'packed', * FROM raw_admissions_full)
SELECT * REPLACE (CASE WHEN NOT isnan(cicid) THEN cicid END AS cicid, CASE WHEN NOT isnan(depdate) THEN depdate END AS depdate) FROM s
""")
def src_admissions_sas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the whole admissions contract from SAS files, read by ranges of
    pages; once with plain rows and once with run-length compressed ones.
    Numbers that are missing (NaN among them) are null, as in SAS."""
    raw, out = fx.stored_admissions(spark, sf_dir, full=True), None
    for stored in ("plain", "packed"):
        uri = write_sas(raw, f"admissions-{stored}", packed=stored == "packed")
        rows = load_raw_admissions(spark, uri, "sas7bdat", options={"partitionBytes": str(1 << 20)})
        rows = rows.select(F.lit(stored).alias("stored"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("src_raw_admissions_csv", """
WITH {raw_admissions} SELECT TRY_CAST(cicid AS BIGINT) AS cicid, DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrival_date,
 DATE '1960-01-01' + TRY_CAST(depdate AS INTEGER) AS departure_date, CAST(i94mode AS INTEGER) AS i94mode,
 CAST(i94visa AS INTEGER) AS i94visa, dtaddto, visatype FROM raw_admissions
""")
def src_raw_admissions_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV variant of the source (every value text, a leading index
    column ``_c0``) through the same loader; numbers and day numbers convert
    from their text (``'20573.0'``) as from doubles."""
    uri = scratch_uri(spark, "raw-admissions-csv")
    raw = fx.raw_admissions(spark, sf_dir)
    raw.select(F.monotonically_increasing_id().alias("_c0"), "*").write.option("header", "true").csv(uri)
    typed = cast_raw(load_raw_admissions(spark, uri, "csv", SLIM_COLUMNS))
    return typed.select("cicid", sas_day_to_date("arrdate").alias("arrival_date"),
                        sas_day_to_date("depdate").alias("departure_date"),
                        "i94mode", "i94visa", "dtaddto", "visatype")


# ------------------------------------------------------------------ code lists
_COUNTRY_LABEL = ("CASE WHEN c_custkey % 5 < 3 THEN 'NA' WHEN c_custkey % 15 = 3 THEN c_mktsegment || 'S' "
                  "WHEN c_custkey % 25 = 4 THEN '' ELSE c_mktsegment END")
_PORT_CITY = ("CASE WHEN s_suppkey % 7 IN (0, 2) THEN 'NA' ELSE 'PORT ' || CAST(s_suppkey % 97 AS VARCHAR) "
              "|| CASE WHEN s_suppkey % 5 = 0 THEN 'S' ELSE '' END END")


@query("dict_country", f"""
SELECT c_custkey AS country_code, {_COUNTRY_LABEL} AS country FROM customer
""")
def dict_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country list text -> (country_code long, country)."""
    uri = fx.write_lines(spark, fx.country_lines(spark, sf_dir), "country-list")
    return read_country(spark, uri)


@query("dict_port", f"""
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS port_of_entry, {_PORT_CITY} AS city,
 CASE WHEN s_suppkey % 7 < 3 THEN NULL ELSE 'N' || CAST(s_nationkey AS VARCHAR) END AS state_code FROM supplier
""")
def dict_port(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Port list text -> (port_of_entry, city, state_code)."""
    uri = fx.write_lines(spark, fx.port_lines(spark, sf_dir), "port-list")
    return read_port(spark, uri)


@query("dict_state", """
SELECT CAST(c_custkey AS VARCHAR) AS state_code, c_mktsegment AS state FROM customer
""")
def dict_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State list text -> (state_code, state)."""
    uri = fx.write_lines(spark, fx.state_lines(spark, sf_dir), "state-list")
    return read_state(spark, uri)


@query("dict_mode", """
SELECT o_orderkey AS transport_code,
 CASE o_orderkey % 4 WHEN 0 THEN 'Air' WHEN 1 THEN 'Sea' WHEN 2 THEN 'Land' ELSE 'Not reported' END AS mode
FROM orders
""")
def dict_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transport-mode list text (tab, numeric key, quoted label) ->
    (transport_code long, mode)."""
    uri = fx.write_lines(spark, fx.mode_lines(spark, sf_dir), "mode-list")
    return read_mode(spark, uri)


@query("dict_visa", """
SELECT c_custkey AS visa_code, CASE c_custkey % 3 WHEN 0 THEN 'Business' WHEN 1 THEN 'Pleasure' ELSE 'Student' END AS visa
FROM customer
""")
def dict_visa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visa list text (unquoted labels) -> (visa_code long, visa)."""
    uri = fx.write_lines(spark, fx.visa_lines(spark, sf_dir), "visa-list")
    return read_visa(spark, uri)


@query("dict_sections", """
SELECT 'country' AS list, CAST(c_custkey AS VARCHAR) AS code, CASE WHEN c_custkey % 5 = 0 THEN 'NA' ELSE c_mktsegment END AS label, NULL AS state_code FROM customer
UNION ALL SELECT 'port', 'S' || CAST(s_suppkey AS VARCHAR), 'PORT ' || CAST(s_suppkey % 97 AS VARCHAR), 'N' || CAST(s_nationkey AS VARCHAR) FROM supplier
UNION ALL SELECT 'mode', CAST(o_orderkey AS VARCHAR), CASE o_orderkey % 4 WHEN 0 THEN 'Air' WHEN 1 THEN 'Sea' WHEN 2 THEN 'Land' ELSE 'Not reported' END, NULL FROM orders
UNION ALL SELECT 'state', CAST(c_custkey AS VARCHAR), c_mktsegment, NULL FROM customer
UNION ALL SELECT 'state', '99999999', 'All Other Codes', NULL
UNION ALL SELECT 'visa', CAST(c_custkey AS VARCHAR), CASE c_custkey % 3 WHEN 0 THEN 'Business' WHEN 1 THEN 'Pleasure' ELSE 'Student' END, NULL FROM customer
""")
def dict_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five lists, the visa list included, from the sections
    of one data dictionary, read in splits."""
    lists = read_dictionary(spark, fx.write_dictionary(spark, sf_dir))
    out = None
    for name, (code, label) in {"country": ("country_code", "country"), "port": ("port_of_entry", "city"), "mode": ("transport_code", "mode"),
                                "state": ("state_code", "state"), "visa": ("visa_code", "visa")}.items():
        state = F.col("state_code") if name == "port" else F.lit(None).cast("string")
        rows = lists[name].select(F.lit(name).alias("list"), F.col(code).cast("string").alias("code"), F.col(label).alias("label"),
                                  state.alias("state_code"))
        out = rows if out is None else out.unionByName(rows)
    return out


# ------------------------------------------------------------------ filters, unions
@query("filter_eq_not_null", """
WITH {raw_admissions} SELECT cicid, depdate, dtaddto FROM raw_admissions WHERE visatype = 'F' AND depdate IS NOT NULL AND dtaddto IS NOT NULL
""")
def filter_eq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """equality and not-null predicates."""
    raw = fx.raw_admissions(spark, sf_dir)
    return (raw.where((F.col("visatype") == "F") & F.col("depdate").isNotNull()
                      & F.col("dtaddto").isNotNull())
               .select("cicid", "depdate", "dtaddto"))


@query("union_port_codes", """
WITH {raw_airports} SELECT ident, iso_region, iata_code AS port_code FROM raw_airports WHERE iso_country = 'US' AND iata_code IS NOT NULL
UNION ALL SELECT ident, iso_region, local_code FROM raw_airports WHERE iso_country = 'US' AND local_code IS NOT NULL
""")
def union_port_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The iata and local branches stacked in one scan."""
    return dims.us_port_codes(fx.raw_airports(spark, sf_dir)).select("ident", "iso_region", "port_code")


@query("region_split_state", """
WITH {raw_airports} SELECT ident, CASE WHEN len(string_split(iso_region, '-')) > 1 THEN string_split(iso_region, '-')[2] END AS state FROM raw_airports
""")
def region_split_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``US-CA`` -> ``CA``, null without a dash."""
    return fx.raw_airports(spark, sf_dir).select("ident", region_state("iso_region").alias("state"))


# ------------------------------------------------------------------ dimensions, dedup
@query("dim_airports", """
WITH {raw_airports}, u AS (
 SELECT 1 AS src, ident, iso_region, iata_code AS port_code FROM raw_airports WHERE iso_country = 'US' AND iata_code IS NOT NULL
 UNION ALL SELECT 2, ident, iso_region, local_code FROM raw_airports WHERE iso_country = 'US' AND local_code IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY port_code ORDER BY src, ident) AS rn FROM u)
SELECT port_code, ident, CASE WHEN len(string_split(iso_region, '-')) > 1 THEN string_split(iso_region, '-')[2] END AS state FROM r WHERE rn = 1
""")
def dim_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 input: D1/F4/X1/P4 — one airport per port code, iata first."""
    return dims.airports(fx.raw_airports(spark, sf_dir)).select("port_code", "ident", "state")


@query("dim_demographics", """
WITH d AS (
 SELECT c_nationkey AS city, CASE WHEN c_nationkey % 7 <> 0 THEN c_nationkey % 5 END AS state,
  c_mktsegment AS race, c_custkey AS n FROM customer)
SELECT city, state, race, n FROM (
 SELECT *, row_number() OVER (PARTITION BY city, state, race ORDER BY n) AS rn FROM d WHERE state IS NOT NULL)
WHERE rn = 1
""")
def dim_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 input: F5/D2 — rows with a state, one per (city, state, race)."""
    rows = fx.demographics_rows(spark, sf_dir)
    return dims.demographics(rows, key=["city", "state", "race"], state_col="state")


@query("dedup_first_by_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
 SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1
""")
def dedup_first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 (keep_first): one line item per (order, line number), first by part,
    supplier and price."""
    li = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return keep_first(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"])


@query("dedup_sieved", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
 SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1
""")
def dedup_sieved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1-D7 for wide rows: only rows whose key repeats are sorted and shuffled."""
    li = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return keep_first_sieved(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"])


# ------------------------------------------------------------------ cleaning
@query("sas_day_to_date", """
WITH {raw_admissions} SELECT TRY_CAST(cicid AS BIGINT) AS cic_id, DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrival_date, DATE '1960-01-01' + TRY_CAST(depdate AS INTEGER) AS departure_date FROM raw_admissions
""")
def sas_day_to_date_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SAS day numbers -> dates (null stays null)."""
    raw = fx.raw_admissions(spark, sf_dir)
    return raw.select(to_number("cicid", "bigint").alias("cic_id"),
                      sas_day_to_date("arrdate").alias("arrival_date"),
                      sas_day_to_date("depdate").alias("departure_date"))


@query("strip_nonword", """
WITH {raw_admissions} SELECT TRY_CAST(cicid AS BIGINT) AS cic_id, regexp_replace(dtaddto, '[^A-Za-z0-9_]+', '', 'g') AS dtaddto FROM raw_admissions
""")
def strip_nonword_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove non-word characters."""
    raw = fx.raw_admissions(spark, sf_dir)
    return raw.select(to_number("cicid", "bigint").alias("cic_id"),
                      strip_nonword("dtaddto").alias("dtaddto"))


@query("admitted_until_date", """
WITH {raw_admissions}, w AS (SELECT cicid, regexp_replace(dtaddto, '[^A-Za-z0-9_]+', '', 'g') AS s FROM raw_admissions WHERE dtaddto IS NOT NULL),
d AS (SELECT cicid, CAST(try_strptime(CASE WHEN regexp_matches(s, '^[0-9]{8}$') THEN s END, '%m%d%Y') AS DATE) AS person_allowed_date FROM w)
SELECT TRY_CAST(cicid AS BIGINT) AS cic_id, person_allowed_date FROM d WHERE person_allowed_date IS NOT NULL
""")
def admitted_until_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admitted-until text -> date; invalid rows dropped."""
    raw = fx.raw_admissions(spark, sf_dir).where(F.col("dtaddto").isNotNull())
    out = raw.select(to_number("cicid", "bigint").alias("cic_id"),
                     admitted_until("dtaddto").alias("person_allowed_date"))
    return out.where(F.col("person_allowed_date").isNotNull())


@query("cast_projection", """
WITH {raw_admissions} SELECT TRY_CAST(cicid AS BIGINT) AS cicid, CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon, CAST(i94cit AS INTEGER) AS i94cit, CAST(i94mode AS INTEGER) AS i94mode, CAST(i94visa AS INTEGER) AS i94visa, visatype FROM raw_admissions
""")
def cast_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5/X11: contract casts (ANSI-safe)."""
    raw = fx.raw_admissions(spark, sf_dir)
    return cast_raw(raw.select("cicid", "i94yr", "i94mon", "i94cit", "i94mode", "i94visa", "visatype"))


@query("cast_exact_keys", """
SELECT o_orderkey, o_orderkey + 9007199254740993 AS from_bigint, o_orderkey + 9007199254740993 AS from_text,
 o_orderkey + 9007199254740993 AS from_fraction, o_orderkey + 9007199254740993 AS from_decimal FROM orders
""")
def cast_exact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5/X11: whole numbers above 2^53 keep every digit, as bigint, decimal,
    and text with or without a fraction."""
    key = F.col("o_orderkey") + F.lit(9007199254740993)
    raw = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", key.alias("b"), key.cast("string").alias("t"),
        F.concat(key.cast("string"), F.lit(".0")).alias("f"), key.cast("decimal(25,3)").alias("d"))
    return raw.select("o_orderkey", *[to_number(c, "bigint").alias(n) for c, n in (
        ("b", "from_bigint"), ("t", "from_text"), ("f", "from_fraction"), ("d", "from_decimal"))])


# ------------------------------------------------------------------ lookups, fact
@query("lookup_left_join", """
WITH {raw_admissions} SELECT TRY_CAST(cicid AS BIGINT) AS cic_id, m.mode AS arrival_mode, v.visa AS visa_code FROM raw_admissions
LEFT JOIN (VALUES (1,'Business'),(2,'Pleasure'),(3,'Student')) v(code, visa) ON CAST(i94visa AS INTEGER) = v.code
LEFT JOIN (VALUES (1,'Air'),(2,'Sea'),(3,'Land'),(9,'Not reported')) m(code, mode) ON CAST(i94mode AS INTEGER) = m.code
""")
def lookup_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left joins to the mode and visa lookups (broadcast,
    de-duplicated); unknown codes keep the row with a null label."""
    raw = cast_raw(fx.raw_admissions(spark, sf_dir).select("cicid", "i94mode", "i94visa"))
    out = lookup_left(raw, default_mode(spark), "i94mode", "transport_code",
                      [("mode", "arrival_mode")], bounded=True, unique=True)
    out = lookup_left(out, default_visa(spark), "i94visa", "visa_code",
                      [("visa", "visa_code")], bounded=True, unique=True)
    return out.select(F.col("cicid").alias("cic_id"), "arrival_mode", "visa_code")


@query("lookup_salted", """
WITH {raw_admissions} SELECT TRY_CAST(cicid AS BIGINT) AS cic_id, i94mode::INTEGER AS i94mode,
 CASE WHEN o_orderkey IS NOT NULL THEN CASE o_orderkey % 4 WHEN 0 THEN 'Air' WHEN 1 THEN 'Sea' WHEN 2 THEN 'Land' ELSE 'Not reported' END END AS arrival_mode
FROM raw_admissions LEFT JOIN orders ON o_orderkey = CAST(i94mode AS BIGINT)
""")
def lookup_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1/J2 beyond the broadcast bound: a list that grows with the data, and
    rows that gather on five codes (or none): hot codes are salted."""
    raw = cast_raw(fx.raw_admissions(spark, sf_dir).select("cicid", "i94mode"))
    mode = read_mode(spark, fx.write_lines(spark, fx.mode_lines(spark, sf_dir), "mode-list"))
    out = salted_lookup_left(raw, mode, "i94mode", "transport_code", [("mode", "arrival_mode")], unique=True)
    return out.select(F.col("cicid").alias("cic_id"), "i94mode", "arrival_mode")


def build_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admissions(fx.stored_admissions(spark, sf_dir), default_mode(spark), default_visa(spark),
                      lookups_bounded=True, lookups_unique=True)


@query("fact_admissions", """
WITH {raw_admissions}, {fact} SELECT * FROM fact
""")
def fact_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The admissions fact: F9-F12, X7-X11, P5-P6, J1-J2, D7."""
    return build_fact(spark, sf_dir)


@query("fact_list_files", """
WITH {raw_admissions}, {fact} SELECT f.cic_id, f.arrival_date,
 CASE WHEN o.o_orderkey IS NOT NULL THEN CASE o.o_orderkey % 4 WHEN 0 THEN 'Air' WHEN 1 THEN 'Sea' WHEN 2 THEN 'Land' ELSE 'Not reported' END END AS arrival_mode,
 CASE c.c_custkey % 3 WHEN 0 THEN 'Business' WHEN 1 THEN 'Pleasure' WHEN 2 THEN 'Student' END AS visa_code
FROM (SELECT *, row_number() OVER (PARTITION BY TRY_CAST(cicid AS BIGINT) ORDER BY """ + _ORDER_SLIM + """) AS r2 FROM clean
 WHERE allowed IS NOT NULL AND TRY_CAST(cicid AS BIGINT) IS NOT NULL) k
JOIN fact f ON f.cic_id = TRY_CAST(k.cicid AS BIGINT) AND k.r2 = 1
LEFT JOIN orders o ON o.o_orderkey = CAST(k.i94mode AS BIGINT) LEFT JOIN customer c ON c.c_custkey = CAST(k.i94visa AS BIGINT)
""")
def fact_list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1/J2 with list files: mode and visa lists that grow with the data are
    read, checked for size and joined."""
    mode = read_mode(spark, fx.write_lines(spark, fx.mode_lines(spark, sf_dir), "mode-list"))
    visa = read_visa(spark, fx.write_lines(spark, fx.visa_lines(spark, sf_dir), "visa-list"))
    fact = admissions(fx.stored_admissions(spark, sf_dir), mode, visa, lookups_unique=True)
    return fact.select("cic_id", "arrival_date", "arrival_mode", "visa_code")


def _mart(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    fact = build_fact(spark, sf_dir)
    uri = scratch_uri(spark, f"mart-{layout}")
    write_mart(fact, uri, LAYOUTS[layout])
    return read_mart(spark, uri, fact_schema(fact.columns))


@query("mart_by_visa_type", """
WITH {raw_admissions}, {fact} SELECT * FROM fact WHERE year_of_entry = 1998 AND visa_type = 'F'
""")
def mart_by_visa_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact by (year, month, visa type); read back with pruning."""
    m = _mart(spark, sf_dir, "visatype")
    return m.where((F.col("year_of_entry") == 1998) & (F.col("visa_type") == "F"))


@query("mart_by_arrival_date", """
WITH {raw_admissions}, {fact} SELECT * FROM fact WHERE arrival_date >= DATE '1998-03-01' AND arrival_date < DATE '1998-04-01'
""")
def mart_by_arrival_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact by arrival date; one month read back."""
    m = _mart(spark, sf_dir, "arrival_date")
    return m.where((F.col("arrival_date") >= F.lit("1998-03-01").cast("date"))
                   & (F.col("arrival_date") < F.lit("1998-04-01").cast("date")))


@query("mart_by_citizenship", """
WITH {raw_admissions}, {fact} SELECT * FROM fact WHERE country_of_citizenship = 7
""")
def mart_by_citizenship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact by (year, month, citizenship); one country read back."""
    m = _mart(spark, sf_dir, "citizenship")
    return m.where(F.col("country_of_citizenship") == 7)


# ------------------------------------------------------------------ full contracts
_DIM_AIRPORTS_SQL = """
WITH {raw_airports_full}, u AS (
 SELECT 0 AS src, ident, "type", "name", elevation_ft, continent, iso_country, iso_region, municipality, gps_code, iata_code AS port_code, coordinates
 FROM raw_airports_full WHERE iso_country = 'US' AND iata_code IS NOT NULL
 UNION ALL SELECT 1, ident, "type", "name", elevation_ft, continent, iso_country, iso_region, municipality, gps_code, local_code, coordinates
 FROM raw_airports_full WHERE iso_country = 'US' AND local_code IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY port_code ORDER BY src, ident) AS rn FROM u)
SELECT ident, "type", "name", elevation_ft, continent, iso_country, municipality, gps_code, port_code, coordinates,
 CASE WHEN len(string_split(iso_region, '-')) > 1 THEN string_split(iso_region, '-')[2] END AS state FROM r WHERE rn = 1
"""


@query("dim_airports_csv", _DIM_AIRPORTS_SQL)
def dim_airports_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 input end to end: the 12-column airport-codes CSV (all text) ->
    airport dimension with the published columns."""
    uri = scratch_uri(spark, "airport-codes")
    fx.raw_airports(spark, sf_dir, full=True).write.option("header", "true").csv(uri)
    raw = read_delimited(spark, uri, header=True, required=AIRPORT_COLUMNS)
    return dims.airports(raw)


_DEMO_COLS = ("City, State, median_age, male_population, female_population, total_population, "
              "number_of_veterans, Foreign_born, Average_Household_Size, State_Code, Race, \"Count\"")


_DEMO_SQL = """
WITH d AS (
 SELECT 'City ' || CAST(c_nationkey AS VARCHAR) AS City,
  CASE WHEN c_nationkey % 7 <> 0 THEN 'State ' || CAST(c_nationkey % 5 AS VARCHAR) END AS State,
  CAST(c_custkey % 600 AS DOUBLE) / 10 AS median_age,
  CAST(c_custkey % 1000 AS INTEGER) AS male_population, CAST(c_custkey % 1100 AS INTEGER) AS female_population,
  CAST(c_custkey % 1000 + c_custkey % 1100 AS INTEGER) AS total_population,
  CAST(c_custkey % 90 AS INTEGER) AS number_of_veterans, CAST(c_custkey % 300 AS INTEGER) AS Foreign_born,
  CAST(c_custkey % 500 AS DOUBLE) / 100 AS Average_Household_Size,
  'S' || CAST(c_nationkey % 5 AS VARCHAR) AS State_Code, c_mktsegment AS Race, CAST(c_custkey AS INTEGER) AS "Count"
 FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY City, State, Race, State_Code ORDER BY median_age, male_population,
  female_population, total_population, number_of_veterans, Foreign_born, Average_Household_Size, "Count") AS rn
 FROM d WHERE State IS NOT NULL)
SELECT """ + _DEMO_COLS + """ FROM r WHERE rn = 1
"""


@query("dim_demographics_csv", _DEMO_SQL)
def dim_demographics_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 input end to end: the ';' demographics file (header with blanks and
    dashes) read by position with the 12-column contract, rows without a
    state dropped, one row per (City, State, Race, State_Code)."""
    uri = scratch_uri(spark, "demographics")
    fx.demographics_source(spark, sf_dir).write.option("header", "true").option("sep", ";").csv(uri)
    return dims.demographics(read_delimited(spark, uri, sep=";", header=True, schema=DEMOGRAPHICS))


@query("fact_admissions_full", """
WITH {raw_admissions_full}, {fact_full} SELECT * FROM fact_full
""")
def fact_admissions_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with the whole 20-column contract (P5/P6 in full)."""
    raw = fx.stored_admissions(spark, sf_dir, full=True)
    return admissions(raw, default_mode(spark), default_visa(spark),
                      lookups_bounded=True, lookups_unique=True)


# ------------------------------------------------------------------ published dimensions
def _published(spark: SparkSession, table: str, df: DataFrame, schema: T.StructType) -> DataFrame:
    """Write a dimension in its published layout and read it back."""
    uri = scratch_uri(spark, f"dim-{table}")
    write_mart(df, uri, LAYOUTS[table])
    return read_mart(spark, uri, schema)


@query("mart_airports_by_state", "SELECT * FROM (" + _DIM_AIRPORTS_SQL + ") WHERE state = 'BUILDING'")
def mart_airports_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports by state; one state read back (partition pruning)."""
    m = _published(spark, "airports", dim_airports_csv(spark, sf_dir), AIRPORTS)
    return m.where(F.col("state") == "BUILDING")


@query("mart_demographics_by_state", "SELECT * FROM (" + _DEMO_SQL + ") WHERE State = 'State 1'")
def mart_demographics_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics by (State, City); one state read back."""
    m = _published(spark, "demographics", dim_demographics_csv(spark, sf_dir), DEMOGRAPHICS)
    return m.where(F.col("State") == "State 1")


@query("mart_country_by_country", f"""
SELECT * FROM (SELECT c_custkey AS country_code, {_COUNTRY_LABEL} AS country FROM customer) WHERE country = 'NA'
""")
def mart_country_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country by label; the placeholder partition read back."""
    m = _published(spark, "country", dict_country(spark, sf_dir), COUNTRY)
    return m.where(F.col("country") == "NA")


@query("mart_port_by_city", f"""
SELECT * FROM (
 SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS port_of_entry, {_PORT_CITY} AS city,
  CASE WHEN s_suppkey % 7 < 3 THEN NULL ELSE 'N' || CAST(s_nationkey AS VARCHAR) END AS state_code
 FROM supplier) WHERE city <> 'NA'
""")
def mart_port_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ports by city; every real city read back (placeholder pruned)."""
    m = _published(spark, "portOfEntry", dict_port(spark, sf_dir), PORT)
    return m.where(F.col("city") != "NA")


@query("mart_state_by_state", """
SELECT * FROM (SELECT CAST(c_custkey AS VARCHAR) AS state_code, c_mktsegment AS state FROM customer)
WHERE state >= 'HOUSEHOLD'
""")
def mart_state_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States by name; a range of partitions read back."""
    m = _published(spark, "state", dict_state(spark, sf_dir), STATE)
    return m.where(F.col("state") >= "HOUSEHOLD")


# ------------------------------------------------------------------ whole star
_FULL_COLS = ", ".join(fact_schema().fieldNames())


@query("star_fact_layouts", """
WITH {raw_admissions_full}, {fact_full} SELECT l.layout, """ + _FULL_COLS + """
FROM fact_full CROSS JOIN (VALUES ('visatype'), ('arrival_date'), ('citizenship')) l(layout)
""")
def star_fact_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6-K9: the admissions job publishes all three layouts of the 20-column
    fact; every row of each is read back."""
    raw = scratch_uri(spark, "raw-admissions")
    fx.raw_admissions(spark, sf_dir, full=True).write.parquet(raw)
    uris = star.publish_admissions(spark, raw, scratch_uri(spark, "star"))
    out = None
    for layout, uri in uris.items():
        rows = star.read_published(spark, layout, uri).withColumn("layout", F.lit(layout))
        out = rows if out is None else out.unionByName(rows)
    return out.select("layout", *fact_schema().fieldNames())


def _published_star(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The five dimensions and one layout of the fact, published; the airport
    table gets a row without a key and a repeated one on top, so that its
    report has something to find."""
    inputs = fx.write_star_inputs(spark, sf_dir)
    out = scratch_uri(spark, "star")
    uris = {"airports": star.publish_airports(spark, inputs.airports_csv, out),
            "demographics": star.publish_demographics(spark, inputs.demographics_csv, out),
            "country": star.publish_country(spark, inputs.country_list, out),
            "portOfEntry": star.publish_ports(spark, inputs.port_list, out),
            "state": star.publish_states(spark, inputs.state_list, out),
            "citizenship": star.table_uri(out, "citizenship")}
    write_mart(star.build_fact(spark, inputs), uris["citizenship"], LAYOUTS["citizenship"])
    states = read_mart(spark, uris["state"], STATE)
    odd = states.where("state_code IN ('1', '2')").withColumn(
        "state_code", F.when(F.col("state_code") == "1", F.lit("2")))
    write_mart(odd, uris["state"], LAYOUTS["state"], mode="append")
    return uris


_STATE_ROWS = """(SELECT CAST(c_custkey AS VARCHAR) AS state_code, c_mktsegment AS state FROM customer
 UNION ALL SELECT CASE WHEN c_custkey = 1 THEN '2' END, c_mktsegment FROM customer WHERE c_custkey IN (1, 2))"""


@query("dq_published_keys", "WITH {raw_admissions_full}, {fact_full}, a AS (" + _DIM_AIRPORTS_SQL + f"""),
t AS (SELECT 'airports' AS table_name, count(*) AS row_count, 0 AS null_keys, 0 AS surplus_rows FROM a
 UNION ALL SELECT 'demographics', count(DISTINCT (c_nationkey, c_mktsegment)), 0, 0 FROM customer WHERE c_nationkey % 7 <> 0
 UNION ALL SELECT 'country', count(*), 0, 0 FROM customer UNION ALL SELECT 'portOfEntry', count(*), 0, 0 FROM supplier
 UNION ALL SELECT 'state', count(*), count(*) FILTER (WHERE state_code IS NULL), count(*) FILTER (WHERE state_code IS NOT NULL)
  - count(DISTINCT state_code) FROM {_STATE_ROWS}
 UNION ALL SELECT 'citizenship', count(*), 0, 0 FROM fact_full)
SELECT table_name, row_count, CAST(null_keys AS BIGINT) AS null_keys, CAST(surplus_rows AS BIGINT) AS surplus_rows,
 row_count >= CASE table_name WHEN 'airports' THEN 1000000000 ELSE 1 END AS enough_rows FROM t
""")
def dq_published_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2-Q4: rows, null and surplus keys of the six published tables, and
    whether each holds enough rows (the airports' minimum is set out of reach)."""
    return star.published_key_report(spark, _published_star(spark, sf_dir), {"airports": 1_000_000_000})


def _published_schema_sql() -> str:
    parts = []
    for name, contract, rows in (
            ("airports", AIRPORTS, "a"), ("demographics", DEMOGRAPHICS, "d"), ("country", COUNTRY, "co"),
            ("portOfEntry", PORT, "po"), ("state", STATE, "st"), ("citizenship", fact_schema(), "fact_full")):
        for f in contract.fields:
            t = f.dataType.simpleString()
            parts.append(f"SELECT '{name}' AS table_name, '{f.name}' AS column_name, '{t}' AS expected_type, "
                         f"'{t}' AS actual_type, true AS ok, count(*) - count(\"{f.name}\") AS null_count FROM {rows}")
    return ("WITH {raw_admissions_full}, {fact_full}, a AS (" + _DIM_AIRPORTS_SQL + "), d AS (" + _DEMO_SQL + "),\n"
            f"co AS (SELECT c_custkey AS country_code, nullif({_COUNTRY_LABEL}, '') AS country FROM customer),\n"
            f"po AS (SELECT 'S' AS port_of_entry, {_PORT_CITY} AS city, CASE WHEN s_suppkey % 7 < 3 THEN NULL "
            "ELSE 'N' END AS state_code FROM supplier),\n"
            f"st AS (SELECT * FROM {_STATE_ROWS})\n" + "\nUNION ALL ".join(parts))


@query("dq_published_schema", _published_schema_sql())
def dq_published_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: types and nulls of every column of the six published tables (an
    empty partition value is stored as null)."""
    report = star.published_schema_report(spark, _published_star(spark, sf_dir))
    return report.select("table_name", "column_name", "expected_type", "actual_type", "ok", "null_count")


# ------------------------------------------------------------------ publishing
_STAR_TABLES = (("airports", AIRPORTS, "a"), ("demographics", DEMOGRAPHICS, "d"), ("country", COUNTRY, "co"),
                ("portOfEntry", PORT, "po"), ("state", STATE, "st"), ("visatype", fact_schema(), "fact_full"),
                ("arrival_date", fact_schema(), "fact_full"), ("citizenship", fact_schema(), "fact_full"))
_DIMENSION_CTES = ("a AS (" + _DIM_AIRPORTS_SQL + "), d AS (" + _DEMO_SQL + "),\n"
                   f"co AS (SELECT c_custkey AS country_code, nullif({_COUNTRY_LABEL}, '') AS country FROM customer),\n"
                   f"po AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS port_of_entry, {_PORT_CITY} AS city, "
                   "CASE WHEN s_suppkey % 7 < 3 THEN NULL ELSE 'N' || CAST(s_nationkey AS VARCHAR) END AS state_code FROM supplier),\n"
                   "st AS (SELECT CAST(c_custkey AS VARCHAR) AS state_code, c_mktsegment AS state FROM customer)")
_REASON_SQL = ("CASE WHEN depdate IS NULL THEN 0 WHEN dtaddto IS NULL THEN 1 WHEN TRY_CAST(depdate AS INTEGER) IS NULL THEN 2 "
               "WHEN try_strptime(CASE WHEN regexp_matches(regexp_replace(dtaddto, '[^A-Za-z0-9_]+', '', 'g'), '^[0-9]{8}$') "
               "THEN regexp_replace(dtaddto, '[^A-Za-z0-9_]+', '', 'g') END, '%m%d%Y') IS NULL THEN 3 "
               "WHEN TRY_CAST(cicid AS BIGINT) IS NULL THEN 4 ELSE 5 END")


def _manifest_sql() -> str:
    parts = []
    for name, contract, rows in _STAR_TABLES:
        parts.append(f"SELECT '{name}' AS table_name, 'rows' AS metric, count(*) AS value FROM {rows}")
        parts.append(f"SELECT '{name}', 'rows read', count(*) FROM {rows}")
        parts += [f"SELECT '{name}', 'nulls:{f.name}', count(*) - count(\"{f.name}\") FROM {rows}" for f in contract.fields]
    for i, reason in enumerate(("no_departure_date", "no_admitted_until", "invalid_departure_date", "invalid_admitted_until", "no_cic_id")):
        parts.append(f"SELECT 'admissions', '{reason}', count(*) FILTER (r = {i}) FROM reasons")
    parts.append("SELECT 'admissions', 'duplicate_cic_id', count(*) FILTER (r = 5) - count(DISTINCT k) FILTER (r = 5) FROM reasons")
    parts.append("SELECT 'admissions', 'kept', count(DISTINCT k) FILTER (r = 5) FROM reasons")
    return ("WITH {raw_admissions_full}, {fact_full}, " + _DIMENSION_CTES + ",\n"
            f"reasons AS (SELECT {_REASON_SQL} AS r, TRY_CAST(cicid AS BIGINT) AS k FROM raw_admissions_full)\n"
            + "\nUNION ALL ".join(parts))


@query("star_manifest", _manifest_sql())
def star_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight tables published together; a second
    star that fails before its commit changes nothing. The manifest tells rows,
    nulls and drop reasons as counted while writing (no scan of inputs or
    tables); ``rows read`` counts the rows that readers find."""
    out = scratch_uri(spark, "star")
    done = star.publish_star(spark, fx.write_star_inputs(spark, sf_dir), out)
    unfinished = publish.Publication(spark, out)
    unfinished.write(fx.demographics_rows(spark, sf_dir), "demographics", "demographics", ["state"])  # never committed
    read = None
    for name in done.tables:
        rows = publish.read_table(spark, out, name).agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(name).alias("table_name"), F.lit("rows read").alias("metric"), "value")
        read = rows if read is None else read.unionByName(rows)
    return star.observed_report(spark, publish.manifest(spark, out)).unionByName(read)


_DIMENSION_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, " + ", ".join(
        f"CAST({'\"' + c + '\"' if c in contract.fieldNames() else 'NULL'} AS VARCHAR) AS \"{c}\""
        for c in dict.fromkeys(f for _, s, _ in _STAR_TABLES[:5] for f in s.fieldNames() if f != "Count" and f not in (
            "median_age", "Average_Household_Size"))) + f" FROM {rows}"
    for name, contract, rows in _STAR_TABLES[:5])


@query("star_dimension_layouts", "WITH " + _DIMENSION_CTES + "\n" + _DIMENSION_ROWS)
def star_dimension_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1-K5: every row of the five published dimensions, read back from their
    layouts as text (columns that a table lacks are null). Some columns differ
    only by case (``state``, ``State``), so that the session tells cases apart
    from here until its scratch is released."""
    inputs, out = fx.write_star_inputs(spark, sf_dir), scratch_uri(spark, "star")
    uris = {"airports": star.publish_airports(spark, inputs.airports_csv, out),
            "demographics": star.publish_demographics(spark, inputs.demographics_csv, out),
            "country": star.publish_country(spark, inputs.country_list, out),
            "portOfEntry": star.publish_ports(spark, inputs.port_list, out),
            "state": star.publish_states(spark, inputs.state_list, out)}
    names = list(dict.fromkeys(f for _, s, _ in _STAR_TABLES[:5] for f in s.fieldNames() if f != "Count" and f not in (
        "median_age", "Average_Household_Size")))
    rows = None
    for name, uri in uris.items():
        table = star.read_published(spark, name, uri)
        exact = {c: c for c in table.columns}
        part = table.select(F.lit(name).alias("table_name"), *[
            (F.col(c) if c in exact else F.lit(None)).cast("string").alias(f"c{i}") for i, c in enumerate(names)])
        rows = part if rows is None else rows.unionByName(part)
    distinguish_case(spark)
    return rows.toDF("table_name", *names)


@query("dq_layouts_agree", """
WITH {raw_admissions_full}, {fact_full} SELECT l.table_name, (SELECT count(*) FROM fact_full) AS row_count, l.agrees
FROM (VALUES ('visatype', true), ('arrival_date', true), ('citizenship', true), ('one row changed', (SELECT count(*) = 0 FROM fact_full)),
 ('moved rows', true)) l(table_name, agrees)
""")
def dq_layouts_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the three layouts of the fact hold the same rows, by
    order-free fingerprints; a layout with one row changed does not, one with
    its rows in other places does."""
    raw = scratch_uri(spark, "raw-admissions")
    fx.raw_admissions(spark, sf_dir, full=True).write.parquet(raw)
    uris = star.publish_admissions(spark, raw, scratch_uri(spark, "star"))
    tables = {name: star.read_published(spark, name, uri) for name, uri in uris.items()}
    last = tables["citizenship"]
    low = last.agg(F.min("cic_id").alias("low")).first()["low"]
    tables["one row changed"] = last.withColumn("person_age", F.when(F.col("cic_id") == low, F.lit(-1)).otherwise(F.col("person_age")))
    tables["moved rows"] = last.repartition("airline")
    return compare_tables(tables, "visatype")


def _file_types_sql() -> str:
    parts = []
    for f in AIRPORTS.fieldNames():
        if f == "state":
            continue
        odd = {"elevation_ft": "'int'", "coordinates": "NULL"}.get(f)
        if odd is None:
            parts.append(f"SELECT '{f}' AS column_name, 'string' AS expected_type, 'string' AS actual_type, n + m AS row_count, true AS ok FROM c")
        else:
            parts += [f"SELECT '{f}', 'string', 'string', n, true FROM c", f"SELECT '{f}', 'string', {odd}, m, false FROM c WHERE m > 0"]
    return ("WITH a AS (" + _DIM_AIRPORTS_SQL + "), c AS (SELECT count(*) AS n, count(*) FILTER (state = 'BUILDING') AS m FROM a)\n"
            + "\nUNION ALL ".join(parts))


@query("dq_file_types", _file_types_sql())
def dq_file_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: the types of every file of a published table, from all footers. One
    state's rows are appended with a number for a text and without a column."""
    uri = scratch_uri(spark, "dim-airports")
    write_mart(dim_airports_csv(spark, sf_dir), uri, LAYOUTS["airports"])
    odd = read_mart(spark, uri, AIRPORTS).where("state = 'BUILDING'")
    later = scratch_uri(spark, "later")  # written apart first: a table is not appended to while it is read
    odd.withColumn("elevation_ft", F.col("elevation_ft").try_cast("int")).drop("coordinates").write.parquet(later)
    write_mart(spark.read.parquet(later), uri, LAYOUTS["airports"], mode="append")
    return file_type_report(spark, uri, AIRPORTS, ("state",))


# ------------------------------------------------------------------ quality
@query("dq_key_report", """
SELECT 'lineitem' AS table_name, count(*) AS row_count, count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS null_keys,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS surplus_rows FROM lineitem
UNION ALL SELECT 'orders', count(*), count(*) FILTER (WHERE o_orderkey IS NULL),
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_orderkey FROM orders)) FROM orders
""")
def dq_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, null keys and surplus rows per table."""
    li = key_report(fx.table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])
    od = key_report(fx.table(spark, sf_dir, "orders"), "orders", ["o_orderkey"])
    return li.unionByName(od)


_FACT_COLS = ["cic_id", "year_of_entry", "month_of_entry", "country_of_citizenship", "arrival_date",
              "arrival_mode", "departure_date", "visa_code", "person_allowed_date", "visa_type"]
_FACT_TYPES = ["bigint", "int", "int", "int", "date", "string", "date", "string", "date", "string"]


def _schema_report_sql() -> str:
    counts = ", ".join(f"count(*) - count({c}) AS {c}" for c in _FACT_COLS)
    values = ",".join(f"('{c}','{t}','{t}',true)" for c, t in zip(_FACT_COLS, _FACT_TYPES))
    return (
        "WITH {raw_admissions}, {fact}, n AS (SELECT " + counts + " FROM fact),\n"
        "u AS (UNPIVOT n ON " + ", ".join(_FACT_COLS) + " INTO NAME column_name VALUE null_count)\n"
        "SELECT t.column_name, t.expected_type, t.actual_type, t.ok, u.null_count FROM (VALUES "
        + values + ") t(column_name, expected_type, actual_type, ok) LEFT JOIN u ON t.column_name = u.column_name"
    )


@query("dq_schema_report", _schema_report_sql())
def dq_schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: fact columns against the contract, with null counts."""
    fact = build_fact(spark, sf_dir)
    return schema_report(fact, fact_schema(fact.columns))


_ADMITTED = ("try_strptime(CASE WHEN regexp_matches(regexp_replace(dtaddto, '[^A-Za-z0-9_]+', '', 'g'), '^[0-9]{8}$') "
             "THEN regexp_replace(dtaddto, '[^A-Za-z0-9_]+', '', 'g') END, '%m%d%Y')")


@query("dq_drop_reasons", """
WITH {raw_admissions}, r AS (
 SELECT CASE WHEN depdate IS NULL THEN 0 WHEN dtaddto IS NULL THEN 1 WHEN TRY_CAST(depdate AS INTEGER) IS NULL THEN 2 WHEN """ + _ADMITTED + """ IS NULL THEN 3
  WHEN TRY_CAST(cicid AS BIGINT) IS NULL THEN 4 ELSE 5 END AS r, TRY_CAST(cicid AS BIGINT) AS k FROM raw_admissions),
t AS (SELECT count(*) FILTER (WHERE r = 0) AS no_departure_date, count(*) FILTER (WHERE r = 1) AS no_admitted_until,
 count(*) FILTER (WHERE r = 2) AS invalid_departure_date, count(*) FILTER (WHERE r = 3) AS invalid_admitted_until,
 count(*) FILTER (WHERE r = 4) AS no_cic_id,
 count(*) FILTER (WHERE r = 5) - count(DISTINCT k) FILTER (WHERE r = 5) AS duplicate_cic_id,
 count(DISTINCT k) FILTER (WHERE r = 5) AS kept FROM r)
SELECT reason, row_count FROM (UNPIVOT t ON no_departure_date, no_admitted_until, invalid_departure_date, invalid_admitted_until, no_cic_id, duplicate_cic_id, kept INTO NAME reason VALUE row_count)
""")
def dq_drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the raw admission rows go, per cleaning rule."""
    return drop_reasons(fx.raw_admissions(spark, sf_dir))


@query("dq_csv_rejects", """
WITH k AS (SELECT c_custkey AS k, c_custkey % 50 = 0 AS few, c_custkey % 50 <> 0 AND c_custkey % 51 = 0 AS many FROM customer),
b AS (SELECT few OR many AS malformed, k % 7 = 1 AS median_age, k % 11 = 2 AS male_population, k % 7 = 4 AS total_population,
 k % 19 = 6 AS "Foreign_born", false AS female_population, false AS number_of_veterans, false AS "Average_Household_Size", false AS "Count" FROM k),
t AS (SELECT count(*) AS "rows", count(*) FILTER (NOT malformed AND NOT median_age AND NOT male_population AND NOT total_population AND NOT "Foreign_born") AS sound_rows,
 count(*) FILTER (malformed) AS malformed_line, count(*) FILTER (median_age) AS "bad_value:median_age", count(*) FILTER (male_population) AS "bad_value:male_population",
 count(*) FILTER (female_population) AS "bad_value:female_population", count(*) FILTER (total_population) AS "bad_value:total_population",
 count(*) FILTER (number_of_veterans) AS "bad_value:number_of_veterans", count(*) FILTER ("Foreign_born") AS "bad_value:Foreign_born",
 count(*) FILTER ("Average_Household_Size") AS "bad_value:Average_Household_Size", count(*) FILTER ("Count") AS "bad_value:Count" FROM b)
SELECT reason, row_count FROM (UNPIVOT t ON COLUMNS(*) INTO NAME reason VALUE row_count)
""")
def dq_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken lines and values that are not of their column's type, per
    reason, with the rows that are sound."""
    uri = fx.write_lines(spark, fx.broken_demographics(spark, sf_dir), "broken-demographics")
    return reject_report(read_with_rejects(spark, uri, DEMOGRAPHICS, sep=";", header=False), DEMOGRAPHICS)


# Parameters of the catch-all lookup check: order status codes with labels.
STATUS_LABELS = [("F", "FILLED"), ("O", "OPEN")]


@query("state_or_other", """
SELECT o_orderkey, coalesce(d.label, 'All Other Codes') AS state FROM orders LEFT JOIN (VALUES ('F','FILLED'),('O','OPEN')) d(code, label) ON o_orderstatus = d.code
""")
def state_or_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: codes missing from the list go into the catch-all label."""
    lookup = values_frame(spark, STATUS_LABELS, T.StructType([
        T.StructField("code", T.StringType()), T.StructField("label", T.StringType())]))
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    out = label_or_other(orders, "o_orderstatus", lookup, "code", "label", "state",
                         "All Other Codes", bounded=True, unique=True)
    return out.select("o_orderkey", "state")
