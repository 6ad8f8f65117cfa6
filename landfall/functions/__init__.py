"""Column expressions (scalar functions) used by the jobs."""

from landfall.functions.cleaning import (
    admitted_until,
    nth_token,
    region_state,
    remove_quotes,
    sas_day_to_date,
    strip_nonword,
    to_na,
    to_number,
    trim_ws,
)

__all__ = [
    "admitted_until", "nth_token", "region_state", "remove_quotes",
    "sas_day_to_date", "strip_nonword", "to_na", "to_number", "trim_ws",
]
