"""Data-quality reports: schema and nulls per column, key health per table,
and why admission rows were dropped.

Each report is one aggregation pass (partial aggregates before any shuffle);
the result is a small DataFrame, never a driver-side loop over data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.cleaning import admitted_until, sas_day_to_date, to_number
from landfall.sources.constants import values_frame


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def schema_report(df: DataFrame, contract: T.StructType,
                  stored: dict[str, str] | None = None) -> DataFrame:
    """One row per contract column: ``column_name, expected_type, actual_type,
    ok, null_count``. A missing column has a null ``actual_type`` and
    ``ok = false``. ``stored`` (column -> type name) replaces the types of
    ``df`` where it was read with a given schema."""
    spark = df.sparkSession
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields} | (stored or {})
    rows = []
    for f in contract.fields:
        exp = f.dataType.simpleString()
        act = actual.get(f.name)
        rows.append((f.name, exp, act, act == exp))
    meta = values_frame(spark, rows, T.StructType([
        T.StructField("column_name", T.StringType()), T.StructField("expected_type", T.StringType()),
        T.StructField("actual_type", T.StringType()), T.StructField("ok", T.BooleanType())]))
    present = [f.name for f in contract.fields if f.name in df.columns]
    if not present:
        return meta.withColumn("null_count", F.lit(None).cast("bigint"))
    counts = df.agg(*[(F.count(F.lit(1)) - F.count(F.col(c))).alias(c) for c in present])
    nulls = counts.unpivot([], present, "column_name", "null_count")
    # both sides hold one row per contract column: bounded, safe to broadcast
    return meta.join(F.broadcast(nulls), "column_name", "left")


def key_report(df: DataFrame, table_name: str, keys: Sequence[str],
               min_rows: int | None = None) -> DataFrame:
    """``table_name, row_count, null_keys, surplus_rows`` for one table, plus
    ``enough_rows`` (row_count >= ``min_rows``) when a minimum is given.

    ``surplus_rows`` = rows minus distinct key tuples (a null key part counts
    as a value), i.e. the rows a keep-first de-duplication would drop.
    One shuffle on the key with map-side partial counts.
    """
    keys = list(keys)
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    zero = F.lit(0).cast("bigint")
    report = groups.agg(
        F.coalesce(F.sum("_n"), zero).alias("row_count"),
        F.coalesce(F.sum(F.when(_any_null(keys), F.col("_n")).otherwise(0)), zero).alias("null_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), zero).alias("surplus_rows"),
    ).select(F.lit(table_name).alias("table_name"), "row_count", "null_keys", "surplus_rows")
    if min_rows is None:
        return report
    return report.withColumn("enough_rows", F.col("row_count") >= F.lit(min_rows))


# Fixed order of the cleaning rules of the admissions fact.
DROP_REASONS = ["no_departure_date", "no_admitted_until", "invalid_departure_date",
                "invalid_admitted_until", "no_cic_id", "duplicate_cic_id", "kept"]


def row_reason() -> Column:
    """The place in ``DROP_REASONS`` of the row rule that drops a raw admission
    row; 5 for rows that reach the de-duplication."""
    return (F.when(F.col("depdate").isNull(), 0).when(F.col("dtaddto").isNull(), 1)
             .when(sas_day_to_date("depdate").isNull(), 2).when(admitted_until(F.col("dtaddto")).isNull(), 3)
             .when(to_number("cicid", "bigint").isNull(), 4).otherwise(5))


def reason_metrics() -> list[Column]:
    """Counts of the row rules as aggregates of the raw rows, for ``observe``:
    one per reason, and ``valid`` rows."""
    names = [*DROP_REASONS[:5], "valid"]
    return [F.count(F.when(row_reason() == i, 1)).alias(n) for i, n in enumerate(names)]


def drop_reasons(raw: DataFrame) -> DataFrame:
    """Where the raw admission rows go: ``reason, row_count`` for each rule of
    the fact job, in the order the rules apply, plus the rows kept.

    One pass for the row rules, one partial-aggregated shuffle on ``cicid``
    for duplicates.
    """
    cic, reason = to_number("cicid", "bigint"), row_reason()
    per_key = (raw.select(reason.alias("_r"), F.when(reason == 5, cic).alias("_k"))
                  .groupBy("_r", "_k").agg(F.count(F.lit(1)).alias("_n")))
    zero = F.lit(0).cast("bigint")
    totals = per_key.agg(
        *[F.coalesce(F.sum(F.when(F.col("_r") == i, F.col("_n"))), zero).alias(DROP_REASONS[i])
          for i in range(5)],
        F.coalesce(F.sum(F.when(F.col("_r") == 5, F.col("_n") - 1)), zero).alias(DROP_REASONS[5]),
        F.coalesce(F.sum(F.when(F.col("_r") == 5, F.lit(1))), zero).alias(DROP_REASONS[6]),
    )
    return totals.unpivot([], DROP_REASONS, "reason", "row_count")
