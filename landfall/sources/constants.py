"""Small constant tables built inside the JVM.

``spark.createDataFrame(list)`` ships pickled rows through a Python RDD, so
every job that reads it (a broadcast, say) starts Python workers. Built as
``inline(array(struct(...)))`` over a one-row range, the same rows stay in
codegen'd JVM operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def values_frame(spark: SparkSession, rows: Sequence[Sequence[object]],
                 schema: T.StructType) -> DataFrame:
    """A DataFrame of the given literal rows with the given schema."""
    names = schema.fieldNames()
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                       for f in schema.fields])
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs))).select(*names)
