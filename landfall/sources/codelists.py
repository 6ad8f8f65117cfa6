"""Code lists: ``key = 'label'`` text (a data dictionary cut into lines).

Shapes handled by one parser (``<k>`` a key, ``<l>`` a label, ``\\t`` a tab)::

       <k> =  '<l>'           country: long key
       '<k>'\\t=\\t'<l>   '     port: quoted string key, padded label
    \\t'<k>'='<l>'            state
    \\t<k> = '<l>'            transport mode
    <k> = <l>                visa (unquoted)

The file is read with ``spark.read.text`` and each line is cut at its first
``=`` on the executors, in time linear in its length; nothing passes through
the driver. Lines without ``=`` are skipped; lines without a key are dropped.
Of lines with the same key the first in the file wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.contracts import MODE, VISA
from landfall.functions.cleaning import remove_quotes, to_na, trim_ws
from landfall.operators.relational import drop_null_keys, keep_first
from landfall.sources.constants import values_frame

# Placeholder labels of the country and port lists become 'NA'.
COUNTRY_PLACEHOLDERS = ["No Country.*", "INVALID.*", "Collapsed.*"]
PORT_PLACEHOLDERS = ["Collapsed.*", "No PORT Code.*"]

# Visa categories of the data dictionary, used when no visa
# list file is given (1 Business, 2 Pleasure, 3 Student).
DEFAULT_VISA_ROWS = [(1, "Business"), (2, "Pleasure"), (3, "Student")]
# Transport modes of the data dictionary, used when no mode
# list file is given (1 Air, 2 Sea, 3 Land, 9 Not reported).
DEFAULT_MODE_ROWS = [(1, "Air"), (2, "Sea"), (3, "Land"), (9, "Not reported")]

_KEY_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType()}


def parse_codelist(lines: DataFrame, key: str, label: str, key_type: str = "string",
                   placeholders: Sequence[str] = (), line_col: str = "value",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Parse a DataFrame of text lines into (key, label) and the ``keep`` columns.

    Lines without ``=`` are skipped. Keys and labels are stripped of quotes and
    surrounding white space, labels also of one closing ``;``; placeholder
    labels are replaced by ``NA``. Keys that do not convert to ``key_type``
    become null.
    """
    cut = lines.where(F.contains(F.col(line_col), F.lit("="))).select(
        F.split(F.replace(F.col(line_col), F.lit("\uFEFF"), F.lit("")), "=", 2).alias("_cut"), *keep)
    raw_key = trim_ws(remove_quotes(F.get("_cut", F.lit(0))))
    tail = trim_ws(F.get("_cut", F.lit(1)))
    raw_label = F.when(tail.endswith(";"), trim_ws(tail.substr(F.lit(1), F.length(tail) - 1))).otherwise(tail)
    lab = remove_quotes(raw_label)
    if placeholders:
        lab = to_na(lab, list(placeholders))
    k = F.when(raw_key != "", raw_key)
    if key_type != "string":
        k = k.try_cast(_KEY_TYPES[key_type])
    return cut.select(k.alias(key), trim_ws(lab).alias(label), *keep)


def read_codelist(spark: SparkSession, uri: str | Sequence[str], key: str, label: str,
                  key_type: str = "string", placeholders: Sequence[str] = ()) -> DataFrame:
    """Read and parse a code list: null keys dropped, one row per key, namely
    the first line with that key (files in path order, then by place)."""
    place = ["_file", "_block", "_line"]
    lines = spark.read.text(uri).select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"))  # ascends within a block
    parsed = drop_null_keys(parse_codelist(lines, key, label, key_type, placeholders, keep=place), [key])
    return keep_first(parsed, [key], place).select(key, label)


def default_visa(spark: SparkSession) -> DataFrame:
    """The visa lookup when no visa list file is given."""
    return values_frame(spark, DEFAULT_VISA_ROWS, VISA)


def default_mode(spark: SparkSession) -> DataFrame:
    """The transport-mode lookup when no mode list file is given."""
    return values_frame(spark, DEFAULT_MODE_ROWS, MODE)


def split_place(df: DataFrame, place: str = "place", city: str = "city",
                state_code: str = "state_code") -> DataFrame:
    """``'<city>, <state>'`` -> city and state_code; token 1 is null when there
    is no comma. Tokens are trimmed."""
    parts = F.split(F.col(place), ",")
    return (df.withColumn(city, trim_ws(F.get(parts, 0)))
              .withColumn(state_code, trim_ws(F.get(parts, 1)))
              .drop(place))


def read_country(spark: SparkSession, uri: str) -> DataFrame:
    """Country list: ``country_code`` (long), ``country`` (placeholders as NA)."""
    return read_codelist(spark, uri, "country_code", "country", "long", COUNTRY_PLACEHOLDERS)


def read_port(spark: SparkSession, uri: str) -> DataFrame:
    """Port list: ``port_of_entry``, ``city``, ``state_code``."""
    ports = read_codelist(spark, uri, "port_of_entry", "place", "string", PORT_PLACEHOLDERS)
    return split_place(ports)


def read_state(spark: SparkSession, uri: str) -> DataFrame:
    """State list: ``state_code``, ``state``."""
    return read_codelist(spark, uri, "state_code", "state", "string")


def read_mode(spark: SparkSession, uri: str | None = None) -> DataFrame:
    """Transport-mode list: ``transport_code`` (long), ``mode``; the
    dictionary's four modes when ``uri`` is None."""
    if uri is None:
        return default_mode(spark)
    return read_codelist(spark, uri, "transport_code", "mode", "long")


def read_visa(spark: SparkSession, uri: str | None = None) -> DataFrame:
    """Visa list: ``visa_code`` (long), ``visa``; the dictionary's three
    categories when ``uri`` is None."""
    if uri is None:
        return default_visa(spark)
    return read_codelist(spark, uri, "visa_code", "visa", "long")
