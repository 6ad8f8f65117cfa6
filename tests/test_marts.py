from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_text
from landfall.plans.marts import read_mart, write_mart
from landfall.session import scratch_uri

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("code", T.StringType()),
                       T.StructField("month", T.IntegerType())])


def test_roundtrip_keeps_partition_text_and_prunes(spark):
    rows = [(1, "01", 1), (2, "1D", 2), (3, None, 3), (4, "01", 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    uri = scratch_uri(spark, "mart-test")
    write_mart(df, uri, ["code", "month"])
    back = read_mart(spark, uri, SCHEMA)
    assert back.columns == ["id", "code", "month"]
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)
    pruned = back.where(F.col("code") == "01")
    assert "PartitionFilters: [isnotnull(code" in plan_text(pruned)
    assert sorted(r.id for r in pruned.collect()) == [1, 4]


def _files(uri, value):
    """(files, rows of the largest file) under a partition directory."""
    import glob

    import pyarrow.parquet as pq

    files = glob.glob(f"{uri.removeprefix('file:')}/code={value}/**/*.parquet", recursive=True)
    return len(files), max(pq.read_metadata(f).num_rows for f in files)


def _hot(spark):
    return spark.range(0, 120_000, numPartitions=6).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 50).cast("string")).alias("code"),
        F.lit(1).alias("month"))


def test_hot_partition_value_is_split(spark):
    """A third of the rows share a value: REBALANCE writes it from several
    tasks, where a plain hash partitioning writes one file."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        uri, plain = scratch_uri(spark, "mart-hot"), scratch_uri(spark, "mart-plain")
        write_mart(_hot(spark), uri, ["code"])
        _hot(spark).repartition(8, "code").write.partitionBy("code").parquet(plain)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert read_mart(spark, uri, SCHEMA).count() == 120_000
    assert _files(plain, "HOT") == (1, 40_000)
    n, largest = _files(uri, "HOT")
    assert n >= 4 and largest <= 20_000


def test_hot_placeholder_of_a_dimension_is_split(spark):
    """The country list's NA label (three fifths of the list)."""
    from landfall.plans import star

    lines = spark.range(0, 60_000).select(F.concat(
        F.col("id").cast("string"), F.lit(" = '"),
        F.when(F.col("id") % 5 < 3, F.lit("INVALID: x")).otherwise(F.concat(F.lit("L"), F.col("id") % 40)), F.lit("'")))
    source, out = scratch_uri(spark, "country-lines"), scratch_uri(spark, "star")
    lines.write.text(source)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        uri = star.publish_country(spark, source, out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    import glob

    import pyarrow.parquet as pq

    files = glob.glob(f"{uri.removeprefix('file:')}/country=NA/*.parquet")
    rows = [pq.read_metadata(f).num_rows for f in files]
    assert sum(rows) == 36_000 and len(rows) > 1 and max(rows) < 36_000
