"""Partitioned Parquet marts: writer and reader.

Writing uses Spark's ``REBALANCE`` hint on the partition columns: rows are
hash-partitioned on the partition values (each directory is written by as
few tasks as its size needs, so no tasks x values small-file explosion) and
AQE sizes the write tasks at run time: small partitions are coalesced, and a
hot partition value (say one visa type with a third of all rows) is split
into several advisory-sized tasks instead of landing in one. Unlike range
partitioning it needs no sampling pass over the input.

Reading: always with the explicit contract schema (partition values are
then parsed as the contract types, never inferred), columns re-selected in
contract order (partition columns come back last), and filters on
partition columns prune directories (``PartitionFilters`` in the plan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def rebalance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AQE-sized shuffle on ``cols`` (skewed values split, small ones merged)."""
    return df.hint("rebalance", *cols) if cols else df.hint("rebalance")


def write_mart(df: DataFrame, uri: str, partition_cols: Sequence[str],
               mode: str = "overwrite", max_records_per_file: int | None = None,
               options: dict[str, str] | None = None) -> None:
    """Write ``df`` as Hive-style partitioned Parquet at ``uri``.

    Rows are REBALANCEd on the partition columns: AQE sizes the tasks by bytes,
    merges small partitions and splits hot values.
    ``max_records_per_file`` caps file size inside a (large) partition.
    ``options`` go to the writer.
    """
    parts = list(partition_cols)
    writer = rebalance(df, parts).write.mode(mode)
    if parts:
        writer = writer.partitionBy(*parts)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.options(**(options or {})).parquet(uri)


def read_mart(spark: SparkSession, uri: str, schema: T.StructType) -> DataFrame:
    """Read a mart with its contract schema, columns in contract order."""
    return spark.read.schema(schema).parquet(uri).select(*schema.fieldNames())
