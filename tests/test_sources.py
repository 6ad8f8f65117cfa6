import pytest
from pyspark.sql import types as T

from landfall.session import scratch_uri
from landfall.sources.admissions import load_raw_admissions
from landfall.sources.delimited import read_delimited


def _text(spark, lines):
    uri = scratch_uri(spark, "csv-test")
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(uri)
    return uri


def test_csv_header_all_strings(spark):
    uri = _text(spark, ["ident,elevation_ft,iata_code", "A1,100,XYZ", "A2,,"])
    df = read_delimited(spark, uri, required=["ident", "iata_code"])
    assert [f.dataType for f in df.schema.fields] == [T.StringType()] * 3
    assert [tuple(r) for r in df.collect()] == [("A1", "100", "XYZ"), ("A2", None, None)]
    with pytest.raises(ValueError):
        read_delimited(spark, uri, required=["local_code"])


def test_csv_schema_by_position_and_bad_numbers(spark):
    uri = _text(spark, ["City;Median Age;Count", "Austin;33.1;5", "Boston;n/a;x"])
    schema = T.StructType([T.StructField("City", T.StringType()), T.StructField("median_age", T.DoubleType()),
                           T.StructField("Count", T.IntegerType())])
    df = read_delimited(spark, uri, sep=";", schema=schema)
    assert df.columns == ["City", "median_age", "Count"]
    assert [tuple(r) for r in df.collect()] == [("Austin", 33.1, 5), ("Boston", None, None)]


def test_load_raw_admissions_csv_variant_and_contract(spark):
    uri = _text(spark, ["_c0,cicid,arrdate,depdate,dtaddto,extra,i94mode",
                        "0,1.0,20573.0,20580.0,10292016,z,1.0"])
    wanted = ["cicid", "arrdate", "i94mode", "depdate", "dtaddto"]
    assert load_raw_admissions(spark, uri, "csv", wanted).columns == wanted
    with pytest.raises(ValueError, match="gender"):  # not the whole contract, and no column list
        load_raw_admissions(spark, uri, "csv")
    with pytest.raises(ValueError, match="depdate"):
        load_raw_admissions(spark, uri, "csv", ["cicid", "arrdate", "dtaddto"])
    bad = _text(spark, ["cicid,arrdate", "1.0,2.0"])
    with pytest.raises(ValueError):
        load_raw_admissions(spark, bad, "csv")
