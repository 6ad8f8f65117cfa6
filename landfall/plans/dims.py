"""Dimension jobs: airports, city demographics, country, port of entry, state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.contracts import DEMOGRAPHICS_KEY
from landfall.functions.cleaning import region_state
from landfall.operators.relational import drop_null_keys, keep_first, union_codes

# Code columns of an airport row, in priority order (iata first).
AIRPORT_CODE_COLUMNS = ["iata_code", "local_code"]


def us_port_codes(raw_airports: DataFrame, country: str = "US") -> DataFrame:
    """US airports, one row per (airport, code): the iata branch and the local
    branch stacked (duplicates kept, null codes dropped), ``port_code`` in
    place of the two code columns, ``_src`` = 0 for iata, 1 for local."""
    us = raw_airports.where(F.col("iso_country") == country)
    return union_codes(us, AIRPORT_CODE_COLUMNS, "port_code")


def airports(raw_airports: DataFrame, country: str = "US") -> DataFrame:
    """Airport dimension keyed by ``port_code``.

    When several airports share a code, the iata row wins over the local
    row, then the smallest ``ident``. ``iso_region`` is replaced by ``state``
    (the part after ``-``, null without one).
    """
    codes = us_port_codes(raw_airports, country)
    first = keep_first(drop_null_keys(codes, ["port_code"]), ["port_code"], ["_src", "ident"])
    cols = [c for c in first.columns if c not in ("_src", "iso_region")]
    return first.select(*cols, region_state(F.col("iso_region")).alias("state"))


def demographics(df: DataFrame, key: Sequence[str] = tuple(DEMOGRAPHICS_KEY),
                 state_col: str = "State") -> DataFrame:
    """City demographics: rows with a state, one per key (City, State, Race,
    State_Code); among duplicates the first by the remaining columns."""
    return keep_first(df.where(F.col(state_col).isNotNull()), list(key))
