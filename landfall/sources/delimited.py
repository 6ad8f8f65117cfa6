"""Delimited-file sources and column contracts at the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "input") -> DataFrame:
    """Fail early (at plan time, no job) when a source lacks a contract column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns {missing}; has {df.columns}")
    return df


def read_delimited(spark: SparkSession, uri: str | Sequence[str], sep: str = ",",
                   header: bool = True, schema: T.StructType | None = None,
                   required: Sequence[str] = ()) -> DataFrame:
    """Read delimited text.

    * without ``schema`` every column is a string (nothing is inferred, so no
      extra pass over the data);
    * with ``schema`` names and types are assigned by position, whatever the
      header says (``enforceSchema``); values that do not parse become null
      (PERMISSIVE mode).

    Splittable: each file is cut into ``spark.sql.files.maxPartitionBytes``
    chunks and filters/projections written after this call reach the scan.
    """
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", "true").option("mode", "PERMISSIVE")
    else:
        reader = reader.option("inferSchema", "false")
    df = reader.csv(uri)
    return require_columns(df, required, f"delimited source {uri}")
