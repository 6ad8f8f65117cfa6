"""Shared helpers of the training-data operators.

* ``Scratch``: intermediate tables as Parquet under ``spark.checkpoint.dir``
  (shared storage, so a lost executor only re-reads), released when done.
* ``utf8_column``: a string column of an Arrow batch as one byte array with
  row offsets, so that numpy works on whole batches instead of rows.
* ``components``: connected components of an edge table in Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import delete_uri, scratch_uri

# ASCII white space as the contracts define it: space and \t\n\v\f\r.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_CLASS = r"[\x20\x09-\x0D]+"
COMPONENT_ROWS = 100_000  # edges per task of the component search


class Scratch:
    """Intermediate Parquet tables of one operator call.

    ``keep(df)`` writes and rereads a table (cuts lineage, survives executor
    loss). Leaving the ``with`` block deletes every table except those kept
    with ``result=True``, so a call leaves only its small result behind.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_uri(spark, name)
        self._temporary: list[str] = []
        self._n = 0

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        for uri in self._temporary:
            delete_uri(self.spark, uri)

    def path(self, tag: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{tag}"

    def keep(self, df: DataFrame, tag: str, result: bool = False) -> DataFrame:
        uri = self.path(tag)
        if not result:
            self._temporary.append(uri)
        df.write.parquet(uri)
        return self.spark.read.schema(df.schema).parquet(uri)

    def temporary(self, uri: str) -> None:
        """Delete ``uri`` with the other tables."""
        self._temporary.append(uri)


def row_numbers(scratch: Scratch, docs: DataFrame):
    """A function that selects columns of ``docs`` with ``key``, a number of
    each row's own.

    Numbers come from a row's file and place in it, so they are the same in
    every job, whatever tasks read it. Rows that are not read straight from
    Parquet files are written first.
    """
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__place")]
    try:
        files = docs.select(*place)
    except AnalysisException:
        docs = scratch.keep(docs, "rows", result=True)
        files = docs.select(*place)
    names = sorted(r["__file"] for r in files.select("__file").distinct().collect())  # Spark lists them to plan the read
    starts = scratch.spark.createDataFrame([(f, i << 40) for i, f in enumerate(names)], "__name string, __start long")

    def select(*columns):
        rows = docs.select(*columns, *place)
        return rows.join(F.broadcast(starts), F.col("__file") == F.col("__name")).withColumn(
            "key", F.col("__start") + F.col("__place")).drop("__file", "__place", "__name", "__start")

    return select


def let(value, body):
    """Bind ``value`` once: ``body`` may use it many times (also in lambdas)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_column(text):
    """Array of the maximal runs of non-white-space characters (null: empty)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS_CHARS))
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>"))
               .otherwise(F.split(t, WS_CLASS)))


def count_words(text):
    """Number of maximal runs of non-white-space characters (null or blank
    text: 0)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS_CHARS))
    return let(trimmed, lambda t: F.when(t == "", F.lit(0).cast("long"))
               .otherwise(F.size(F.split(t, WS_CLASS)).cast("long")))


def utf8_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; nulls are empty.

    Row ``i`` is ``bytes[offsets[i]:offsets[i + 1]]``.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        width = np.int64
    else:
        width = np.int32
    buffers = col.buffers()
    if n == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(buffers[1], width)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    if col.null_count:
        valid = np.asarray(col.is_valid())
        if (np.diff(offsets)[~valid] != 0).any():
            return utf8_column(pa.compute.fill_null(col, ""))
    data = data[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def batch_slices(offsets: np.ndarray, limit: int):
    """Row ranges whose bytes stay near ``limit`` (one long row stands alone)."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


def components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge table: (node, component),
    the component being its smallest node. Nodes without an edge are absent.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each
    round keeps at most one edge per (node, neighbour) and shrinks paths
    exponentially. Minima are pre-aggregated before the shuffle; the join
    back reads written tables, so a hot centre is split by the skew join.
    """
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    e = scratch.keep(e.where("u <> v").distinct(), "cc-edges")
    parts = 1 + e.count() // COMPONENT_ROWS  # tables of a few rows are not written in many files
    previous = None
    while True:
        # large star: every larger neighbour of u points to the least of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(parts), "cc-min")
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        e = scratch.keep(large.coalesce(parts), "cc-large")
        # small star: a node's smaller neighbours, and the node, point to the least of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        small = (e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = scratch.keep(small.coalesce(parts), "cc-small")
        state = tuple(e.agg(F.count("*"), F.count_distinct("u"), F.sum(F.col("u").cast("decimal(38,0)")),
                            F.sum(F.col("v").cast("decimal(38,0)"))).first())
        if state == previous and state[0] == state[1]:
            break
        previous = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
