"""Column expressions for the cleaning rules.

All are built-in Spark expressions: they run inside whole-stage codegen and
are ANSI-safe (``try_cast`` / ``try_to_date`` / ``get`` give null where plain
``cast`` / ``to_date`` / ``[i]`` would raise on Spark 4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the source's data dictionary for right results):
# the SAS epoch; admitted-until dates are 8 digits, month-day-year.
SAS_EPOCH = "1960-01-01"
ADMITTED_UNTIL_FORMAT = "MMddyyyy"
# Day offsets from the SAS epoch that stay inside the DATE range
# 0001-01-01 .. 9999-12-31; anything further becomes null instead of overflowing.
_MIN_DAY_OFFSET = -715_509
_MAX_DAY_OFFSET = 2_936_549

_WS = " \t\n\x0b\f\r"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_ws(col: Column | str) -> Column:
    """Trim all leading/trailing white space (tabs included; ``F.trim`` only
    removes blanks)."""
    return F.btrim(_c(col), F.lit(_WS))


def remove_quotes(col: Column | str) -> Column:
    """Remove every single quote (``INT''L`` -> ``INTL``)."""
    return F.replace(_c(col), F.lit("'"), F.lit(""))


def to_na(col: Column | str, patterns: list[str], value: str = "NA") -> Column:
    """Replace a placeholder label with ``value``: each pattern is a regex that
    replaces from its match to the end of the text (``'INVALID.*'``)."""
    return F.regexp_replace(_c(col), "|".join(f"(?:{p})" for p in patterns), value)


def nth_token(col: Column | str, sep: str, n: int) -> Column:
    """Token ``n`` (0-based) of a split, null when absent (never raises)."""
    return F.get(F.split(_c(col), sep), F.lit(n))


def region_state(col: Column | str) -> Column:
    """``US-CA`` -> ``CA``; null without a ``-``."""
    return nth_token(col, "-", 1)


def to_number(col: Column | str, dtype: str) -> Column:
    """A raw SAS number (a number, or its text such as ``'5748517.0'`` from a
    CSV export) as ``dtype``, exactly: whole numbers above 2^53 keep every
    digit. A direct cast comes first; text with a fraction or an exponent goes
    through a wide decimal, and what that cannot hold through double. NaN,
    junk and out-of-range values give null; fractions are truncated."""
    c = _c(col)
    return F.coalesce(c.try_cast(dtype), c.try_cast("decimal(38,10)").try_cast(dtype),
                      c.try_cast("double").try_cast(dtype))


def sas_day_to_date(col: Column | str) -> Column:
    """SAS day number (days since 1960-01-01, stored as double or its text)
    -> DATE.

    Null, NaN and numbers outside the DATE range give null.
    """
    days = to_number(col, "int")
    return F.when(
        days.between(_MIN_DAY_OFFSET, _MAX_DAY_OFFSET),
        F.date_add(F.lit(SAS_EPOCH).cast("date"), days),
    )


def strip_nonword(col: Column | str) -> Column:
    """Remove every run of non-word characters (``10/29/2016`` -> ``10292016``)."""
    return F.regexp_replace(_c(col), r"\W+", "")


def may_be_admitted_until(col: Column | str) -> Column:
    """A cheap necessary condition of :func:`admitted_until`: exactly eight
    digits somewhere in the text (no regular expression)."""
    c = _c(col)
    return F.length(c) - F.length(F.translate(c, "0123456789", "")) == 8


def admitted_until(col: Column | str) -> Column:
    """Character admitted-until date -> DATE.

    Non-word characters are removed first; only 8 digits in month-day-year
    order are a date. ``D/S``, ``00000000``, ``99999999``, impossible days
    (``02302016``) and null give null.
    """
    digits = F.regexp_extract(strip_nonword(col), "^([0-9]{8})$", 1)  # '' if it is anything else
    return F.try_to_date(digits, ADMITTED_UNTIL_FORMAT)
