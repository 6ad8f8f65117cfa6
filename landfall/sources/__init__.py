"""Sources: delimited files, code lists and raw admissions."""

from landfall.sources.admissions import load_raw_admissions
from landfall.sources.codelists import (
    COUNTRY_PLACEHOLDERS,
    DEFAULT_MODE_ROWS,
    DEFAULT_VISA_ROWS,
    PORT_PLACEHOLDERS,
    default_mode,
    default_visa,
    parse_codelist,
    read_codelist,
    read_country,
    read_mode,
    read_port,
    read_state,
    read_visa,
    split_place,
)
from landfall.sources.delimited import read_delimited, require_columns

__all__ = [
    "COUNTRY_PLACEHOLDERS", "DEFAULT_MODE_ROWS", "DEFAULT_VISA_ROWS", "default_mode", "PORT_PLACEHOLDERS", "default_visa",
    "load_raw_admissions", "parse_codelist", "read_codelist", "read_country", "read_delimited",
    "read_mode", "read_port", "read_state", "read_visa", "require_columns", "split_place",
]
