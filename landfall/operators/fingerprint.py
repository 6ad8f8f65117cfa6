"""Order-free fingerprints of tables: whether two tables hold the same rows,
without sorting or joining them.

A row is hashed twice with 64 bits (every column and whether it is null); the
fingerprint is the number of rows and the two sums of hashes. Equal multisets of
rows have equal fingerprints, whatever their order, files or partitions;
different ones differ but for a chance of about 2^-128. One aggregation pass
with partial sums, or no pass at all as metrics observed while a table is
written (``fingerprint_metrics``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINGERPRINT = T.StructType([T.StructField("row_count", T.LongType()), T.StructField("hash_a", T.StringType()),
                            T.StructField("hash_b", T.StringType())])


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """64-bit hash of a row. Spark skips nulls when it hashes, so their places
    are hashed too."""
    parts = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def fingerprint_metrics(columns: Sequence[str]) -> list[Column]:
    """The three aggregates, for ``agg`` or ``observe``. Columns count in the
    given order, so that tables with moved columns can be compared."""
    def total(seed):
        return F.coalesce(F.sum(_row_hash(columns, seed).cast("decimal(20,0)")), F.lit(0)).cast("string")

    return [F.count(F.lit(1)).alias("row_count"), total(17).alias("hash_a"), total(71).alias("hash_b")]


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: row_count, hash_a, hash_b."""
    return df.agg(*fingerprint_metrics(columns or df.columns))


def compare_tables(tables: dict[str, DataFrame], first: str) -> DataFrame:
    """``table_name, row_count, agrees``: whether each table holds the rows of
    the table named ``first``, which gives the columns. One pass per table."""
    columns = tables[first].columns
    rows = reduce(DataFrame.unionByName, [fingerprint(df, columns).select(F.lit(n).alias("table_name"), "*")
                                          for n, df in tables.items()])
    # one row per table: all of them, and the first one's, are a handful
    wanted = F.first(F.when(F.col("table_name") == first, F.struct("row_count", "hash_a", "hash_b")), ignorenulls=True)
    gathered = rows.agg(F.collect_list(F.struct("table_name", "row_count", "hash_a", "hash_b")).alias("all"), wanted.alias("wanted"))
    return gathered.select(F.inline(F.transform("all", lambda t: F.struct(
        t["table_name"].alias("table_name"), t["row_count"].alias("row_count"),
        (F.struct(t["row_count"], t["hash_a"], t["hash_b"]) == F.col("wanted")).alias("agrees")))))
