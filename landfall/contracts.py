"""Typed column contracts of every input and output table.

Explicit StructTypes are used on read and on read-back so that no type is
ever inferred (inference re-types partition values, e.g. ``01`` -> 1.0).
"""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, I, L, D, DT = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()

# ---------------------------------------------------------------- inputs
# Column names of the airport-codes CSV (header, all text).
AIRPORT_COLUMNS = [
    "ident", "type", "name", "elevation_ft", "continent", "iso_country",
    "iso_region", "municipality", "gps_code", "iata_code", "local_code", "coordinates",
]

# City demographics, ';'-separated, header present but with other
# names; names are assigned by position.
DEMOGRAPHICS = _schema(
    ("City", S), ("State", S), ("median_age", D), ("male_population", I),
    ("female_population", I), ("total_population", I), ("number_of_veterans", I),
    ("Foreign_born", I), ("Average_Household_Size", D), ("State_Code", S),
    ("Race", S), ("Count", I),
)
DEMOGRAPHICS_KEY = ["City", "State", "Race", "State_Code"]

# The 20 raw admission fields the fact carries, with their raw
# names, output names and output types.
# (raw name, output name, output type)
ADMISSIONS_FIELDS: list[tuple[str, str, T.DataType]] = [
    ("cicid", "cic_id", L),
    ("i94yr", "year_of_entry", I),
    ("i94mon", "month_of_entry", I),
    ("i94cit", "country_of_citizenship", I),
    ("i94res", "country_of_residence", I),
    ("i94port", "port_of_entry", S),
    ("arrdate", "arrival_date", DT),
    ("i94mode", "arrival_mode", S),  # code replaced by the mode label
    ("i94addr", "us_state", S),
    ("depdate", "departure_date", DT),
    ("i94bir", "person_age", I),
    ("i94visa", "visa_code", S),  # holds the visa *label* (output contract name)
    ("visapost", "visa_issuing_post", S),
    ("biryear", "person_birth_year", I),
    ("dtaddto", "person_allowed_date", DT),
    ("gender", "gender", S),
    ("airline", "airline", S),
    ("admnum", "admission_number", L),
    ("fltno", "flight_number", S),
    ("visatype", "visa_type", S),
]
RAW_ADMISSIONS_COLUMNS = [r for r, _, _ in ADMISSIONS_FIELDS]
# Types that raw fields are cast to before lookups (SAS numbers are doubles).
RAW_CASTS: dict[str, T.DataType] = {
    "cicid": L, "i94yr": I, "i94mon": I, "i94cit": I, "i94res": I, "i94mode": I,
    "i94bir": I, "i94visa": I, "biryear": I, "admnum": L,
    "i94port": S, "i94addr": S, "visapost": S, "gender": S, "airline": S,
    "fltno": S, "visatype": S,
}
# The minimum a raw admissions source must provide for the fact job.
ADMISSIONS_REQUIRED = ["cicid", "arrdate", "depdate", "dtaddto"]

FACT_KEY = ["cic_id"]


def fact_columns(raw_columns: list[str]) -> list[str]:
    """Published names of raw admission columns, in contract order."""
    return [o for r, o, _ in ADMISSIONS_FIELDS if r in raw_columns]


def fact_schema(columns: list[str] | None = None) -> T.StructType:
    """Contract of the fact (optionally restricted to the given output columns)."""
    fields = [(o, t) for _, o, t in ADMISSIONS_FIELDS]
    if columns is not None:
        wanted = set(columns)
        fields = [(o, t) for o, t in fields if o in wanted]
    return _schema(*fields)


# ---------------------------------------------------------------- outputs
AIRPORTS = _schema(*[(c, S) for c in ["ident", "type", "name", "elevation_ft", "continent",
                                       "iso_country", "municipality", "gps_code", "port_code",
                                       "coordinates", "state"]])
COUNTRY = _schema(("country_code", L), ("country", S))
PORT = _schema(("port_of_entry", S), ("city", S), ("state_code", S))
STATE = _schema(("state_code", S), ("state", S))
MODE = _schema(("transport_code", L), ("mode", S))
VISA = _schema(("visa_code", L), ("visa", S))

# Partition layout of every published table (table -> partition columns).
LAYOUTS: dict[str, list[str]] = {
    "airports": ["state"],
    "demographics": ["State", "City"],
    "country": ["country"],
    "portOfEntry": ["city"],
    "state": ["state"],
    "visatype": ["year_of_entry", "month_of_entry", "visa_type"],
    "arrival_date": ["arrival_date"],
    "citizenship": ["year_of_entry", "month_of_entry", "country_of_citizenship"],
}
FACT_LAYOUTS = ["visatype", "arrival_date", "citizenship"]
