"""Types and row counts of every file of a Parquet table, from the footers.

The folder is listed once, flat; the list is dealt to tasks, and a task opens
the footers of its files (no data pages). What leaves a task is a row per column
and type.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.sources.constants import values_frame
from landfall.sources.sas7bdat import open_uri

FILES_PER_TASK = 256


def _files(uri: str) -> list[str]:
    """Paths of a table's data files."""
    system, path = open_uri(uri)
    found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and f.base_name.endswith(".parquet") and f.base_name[0] not in "._")


def _footers(root: str, expected: tuple[str, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import from_arrow_type

    system, _ = open_uri(root)
    for b in batches:
        found: dict[tuple[str | None, str | None], list[int]] = {}
        for path in b.column(0).to_pylist():
            with system.open_input_file(path) as stream:
                file = pq.ParquetFile(stream)
                rows = file.metadata.num_rows
                kinds = [(f.name, from_arrow_type(f.type).simpleString()) for f in file.schema_arrow]
            absent = [(c, None) for c in expected if c not in {n for n, _ in kinds}]
            for key in [*kinds, *absent, (None, None)]:  # the last one counts the file itself
                total = found.setdefault(key, [0, 0])
                total[0] += 1
                total[1] += rows
        yield pa.record_batch(
            [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
             pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())],
            names=["column_name", "actual_type", "file_count", "row_count"])


def footer_types(spark: SparkSession, uri: str, expected: tuple[str, ...] = ()) -> DataFrame:
    """``column_name, actual_type, file_count, row_count``: how many files (and
    rows in them) store a column with a type (null: files without one of the
    ``expected`` columns). The row without a column name counts all files."""
    files = _files(uri)
    paths = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, -(-len(files) // FILES_PER_TASK)))
    parts = paths.mapInArrow(partial(_footers, uri, expected), "column_name string, actual_type string, file_count long, row_count long")
    return parts.groupBy("column_name", "actual_type").agg(
        F.sum("file_count").alias("file_count"), F.sum("row_count").alias("row_count"))


def file_type_report(spark: SparkSession, uri: str, contract: T.StructType, stored_apart: tuple[str, ...] = ()) -> DataFrame:
    """``column_name, expected_type, actual_type, row_count, ok``: one row per
    contract column and type found in any file; rows in files without the
    column have a null ``actual_type``; ``ok`` needs the contract's type.
    Columns in ``stored_apart`` (partition columns) are not in the files. A
    table without files has no row."""
    schema = T.StructType([T.StructField("c_name", T.StringType()), T.StructField("expected_type", T.StringType())])
    fields = [(f.name, f.dataType.simpleString()) for f in contract.fields if f.name not in stored_apart]
    wanted = F.broadcast(values_frame(spark, fields, schema))  # one row per contract column
    types = footer_types(spark, uri, tuple(n for n, _ in fields))
    found = types.join(wanted, F.col("column_name") == F.col("c_name"))
    return found.select("column_name", "expected_type", "actual_type", "row_count",
                        F.col("actual_type").eqNullSafe(F.col("expected_type")).alias("ok"))
