"""Publishing is all or nothing; reports come from what was counted meanwhile."""

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SMALL
from landfall import fixtures as fx
from landfall.operators.fingerprint import compare_tables, fingerprint
from landfall.operators.footers import file_type_report, footer_types
from landfall.operators.quality import drop_reasons
from landfall.plans import publish, star
from landfall.session import delete_uri, scratch_uri


@pytest.fixture(scope="module")
def inputs(spark):
    return fx.write_star_inputs(spark, SMALL)


@pytest.fixture(scope="module")
def published(spark, inputs):
    out = scratch_uri(spark, "published")
    return out, star.publish_star(spark, inputs, out)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_star_is_read_through_its_manifest(spark, published):
    out, done = published
    assert set(done.tables) == set(star.TABLE_PATHS) and publish.numbers(spark, out) == [1]
    for name, t in done.tables.items():
        table = publish.read_table(spark, out, name)
        assert [[f.name, f.dataType.simpleString()] for f in table.schema.fields] == t.columns
        got = fingerprint(table).first()
        assert (got.row_count, got.hash_a, got.hash_b) == (t.row_count, t.hash_a, t.hash_b), name
    nulls = done.tables["visatype"].nulls
    fact = publish.read_table(spark, out, "visatype")
    assert nulls == {c: fact.where(F.col(c).isNull()).count() for c in fact.columns}


def test_failure_leaves_the_published_star(spark, published, inputs, monkeypatch):
    out, done = published
    before = _rows(publish.read_table(spark, out, "citizenship"))
    real = publish.Publication.write

    def failing(self, df, table, *rest):
        if table == "citizenship":
            raise RuntimeError("no space left")
        return real(self, df, table, *rest)

    monkeypatch.setattr(publish.Publication, "write", failing)
    with pytest.raises(RuntimeError, match="no space"):
        star.publish_star(spark, inputs, out)
    assert publish.manifest(spark, out).version == done.version
    assert _rows(publish.read_table(spark, out, "citizenship")) == before


def test_killed_process_leaves_the_published_star(spark, published, inputs):
    """The process dies for good after two of three layouts."""
    out, done = published
    script = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {ROOT!r})
        from landfall.plans import publish, star
        from landfall.session import local_session
        spark = local_session(2, 2)
        real = publish.Publication.write
        def dying(self, df, table, *rest):
            if table == "citizenship":
                print("dies", flush=True)
                os._exit(9)
            return real(self, df, table, *rest)
        publish.Publication.write = dying
        star.publish_star(spark, star.StarInputs(**{inputs.__dict__!r}), {out!r}, parallel_jobs=1)
    """)
    ended = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300,
                           env=os.environ | {"LANDFALL_DRIVER_MEMORY": "2g"})
    assert ended.returncode == 9 and "dies" in ended.stdout, ended.stderr[-2000:]
    assert publish.numbers(spark, out) == [1] and publish.manifest(spark, out).version == done.version
    assert publish.read_table(spark, out, "visatype").count() == done.tables["visatype"].row_count
    # what it left is named by no manifest and can be swept
    left = publish.retire(spark, out, keep=1, orphans=True)
    assert left and done.version not in left
    assert publish.read_table(spark, out, "country").count() == done.tables["country"].row_count


def test_two_publishers(spark):
    out = scratch_uri(spark, "two")
    a, b = publish.Publication(spark, out), publish.Publication(spark, out)
    for i, p in enumerate((a, b)):
        p.write(spark.range(5 + i), "t", "t", [])
    assert a.commit().number == 1
    with pytest.raises(publish.PublishError, match="meanwhile"):
        b.commit()
    # also when the other manifest appears after the last look
    b._after = 0
    with pytest.raises(Exception):
        publish._put(spark, b.uri("t"), f"{out}/manifests/00000001.json")
    assert publish.read_table(spark, out, "t").count() == 5
    c = publish.Publication(spark, out)
    c.write(spark.range(9), "t", "t", [])
    assert c.commit().number == 2 and publish.read_table(spark, out, "t").count() == 9
    assert publish.read_table(spark, out, "t", number=1).count() == 5
    assert publish.retire(spark, out, keep=1) == [a.version] and publish.numbers(spark, out) == [2]


def test_versions_that_do_not_fit_are_not_published(spark):
    out = scratch_uri(spark, "misfit")
    p = publish.Publication(spark, out)
    uri = p.write(spark.range(10).withColumn("x", F.col("id") % 3), "t", "t", ["x"])
    spark.range(2).withColumn("x", F.lit(1)).write.mode("append").partitionBy("x").parquet(uri)
    with pytest.raises(publish.PublishError, match="10 rows were written, the files hold 12"):
        p.commit()
    p = publish.Publication(spark, out)
    uri = p.write(spark.range(10).toDF("x"), "t", "t", [])
    spark.range(1).selectExpr("cast(id AS int) AS x").write.mode("append").parquet(uri)
    with pytest.raises(publish.PublishError, match="x is int in "):
        p.commit()
    p = publish.Publication(spark, out)
    p.write(spark.range(10), "a", "a", [])
    p.write(spark.range(1, 11), "b", "b", [])
    with pytest.raises(publish.PublishError, match="different rows"):
        p.commit(same_rows=["a", "b"])
    assert publish.manifest(spark, out) is None
    with pytest.raises(publish.PublishError, match="nothing is published"):
        publish.read_table(spark, out, "a")


def test_odd_partition_values_and_empty_tables(spark):
    out = scratch_uri(spark, "odd")
    p = publish.Publication(spark, out)
    df = spark.createDataFrame([("", 1), (None, 2), ("a b%/é", 3), ("01", 4)], "k string, n int")
    p.write(df, "t", "t", ["k"])
    p.write(df.where("n > 10"), "none", "none", [])
    done = p.commit()
    table = publish.read_table(spark, out, "t")
    assert _rows(table) == sorted([(None, 1), (None, 2), ("a b%/é", 3), ("01", 4)], key=repr)
    got = fingerprint(table).first()
    assert (got.row_count, got.hash_a) == (done.tables["t"].row_count, done.tables["t"].hash_a)
    assert publish.read_table(spark, out, "none").collect() == []


def test_reports_without_inputs_or_tables(spark):
    """The counts were taken while writing: nothing is left to scan."""
    inputs, out = fx.write_star_inputs(spark, SMALL), scratch_uri(spark, "gone")
    wanted = {r.reason: r.row_count for r in drop_reasons(spark.read.parquet(inputs.admissions)).collect()}
    done = star.publish_star(spark, inputs, out)
    rows = publish.read_table(spark, out, "country").count()
    delete_uri(spark, inputs.admissions)
    delete_uri(spark, f"{out}/versions")
    report = {(r.table_name, r.metric): r.value for r in star.observed_report(spark, publish.manifest(spark, out)).collect()}
    assert {r: report["admissions", r] for r in wanted} == wanted and wanted["duplicate_cic_id"] > 0
    assert report["country", "rows"] == rows == done.tables["country"].row_count


def test_fingerprints(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, "b"), (2, "b", None)], "n int, x string, y string")
    same = {"t": df, "moved": df.orderBy(F.desc("x")).repartition(3), "swapped": df.select("y", "x", "n").select("n", "x", "y")}
    assert {r.table_name: r.agrees for r in compare_tables(same, "t").collect()} == dict.fromkeys(same, True)
    other = {"t": df, "less": df.limit(3), "distinct": df.distinct(), "nulls moved": df.select("n", F.col("y").alias("x"), F.col("x").alias("y")),
             "none": df.limit(0)}
    assert [r.table_name for r in compare_tables(other, "t").collect() if r.agrees] == ["t"]


def test_footer_types(spark):
    uri = scratch_uri(spark, "footers")
    spark.range(7).selectExpr("id", "'t' AS s").repartition(3).write.parquet(uri)
    spark.range(2).selectExpr("cast(id AS int) AS id").write.mode("append").parquet(uri)
    got = {(r.column_name, r.actual_type): r.row_count for r in footer_types(spark, uri).collect()}
    assert got == {("id", "bigint"): 7, ("id", "int"): 2, ("s", "string"): 7, (None, None): 9}
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    contract = StructType([StructField("id", LongType()), StructField("s", StringType()), StructField("gone", LongType())])
    report = sorted(map(tuple, file_type_report(spark, uri, contract).collect()), key=repr)
    assert report == sorted([("id", "bigint", "bigint", 7, True), ("id", "bigint", "int", 2, False), ("s", "string", "string", 7, True),
                             ("s", "string", None, 2, False), ("gone", "bigint", None, 9, False)], key=repr)
