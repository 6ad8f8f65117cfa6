"""Delimited text with a reject channel: nothing is lost silently.

A typed CSV read turns a value that does not parse into null, and a line with
too few or too many fields into a row of whatever was there. Read with a
channel, every row tells what was wrong with it: values are read as text, typed
with ``try_cast``, and Spark's corrupt-record column holds lines whose number of
fields is wrong. One pass over the text serves both the rows and the report.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.cleaning import trim_ws

LINE = "_rejected_line"
REASONS = "_reject_reasons"
MALFORMED = "malformed_line"


def read_with_rejects(spark: SparkSession, uri: str | Sequence[str], schema: T.StructType, sep: str = ",",
                      header: bool = True) -> DataFrame:
    """Rows of ``schema`` (names and types by position) with two more columns:
    ``_reject_reasons``, an empty array for a sound row, else ``malformed_line``
    or ``bad_value:<column>`` for each value that is not of its type, and
    ``_rejected_line``, the line's text if its number of fields is wrong."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(LINE, T.StringType())])
    raw = (spark.read.schema(texts).option("header", str(header).lower()).option("sep", sep).option("mode", "PERMISSIVE")
           .option("enforceSchema", "true").option("columnNameOfCorruptRecord", LINE)
           .option("columnPruning", "false")  # a line's fields are counted whatever is selected
           .csv(uri))
    typed, bad = [], []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            typed.append(c)
            continue
        value = trim_ws(c).try_cast(f.dataType)
        typed.append(value.alias(f.name))
        bad.append(F.when(c.isNotNull() & value.isNull(), F.lit(f"bad_value:{f.name}")))
    reasons = F.array_compact(F.array(F.when(F.col(LINE).isNotNull(), F.lit(MALFORMED)), *bad))
    return raw.select(*typed, reasons.alias(REASONS), F.col(LINE))


def sound_rows(rows: DataFrame) -> DataFrame:
    """The rows without a reason, with the contract's columns."""
    return rows.where(F.size(REASONS) == 0).drop(REASONS, LINE)


def reject_metrics(schema: T.StructType) -> list[Column]:
    """Counts per reason as aggregates, for ``agg`` or ``observe`` on
    :func:`read_with_rejects`."""
    def count(reason):
        return F.count(F.when(F.array_contains(REASONS, reason), 1))

    names = [MALFORMED] + [f"bad_value:{f.name}" for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    return [F.count(F.lit(1)).alias("rows"), F.count(F.when(F.size(REASONS) == 0, 1)).alias("sound_rows"),
            *[count(n).alias(n) for n in names]]


def reject_report(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``reason, row_count``: all rows, sound rows, malformed lines and bad
    values per typed column (a row may count for several). One aggregate."""
    counts = rows.agg(*reject_metrics(schema))
    pairs = [F.struct(F.lit(c).alias("reason"), F.col(f"`{c}`").alias("row_count")) for c in counts.columns]
    return counts.select(F.inline(F.array(*pairs)))


def stacked_reports(reports: dict[str, DataFrame]) -> DataFrame:
    """Reports of several sources, with their names."""
    return reduce(DataFrame.unionByName, [r.select(F.lit(n).alias("source"), "*") for n, r in reports.items()])
