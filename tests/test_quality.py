from landfall.contracts import fact_schema
from landfall.operators.quality import drop_reasons, key_report, schema_report


def test_key_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    r = key_report(df, "t", ["a", "b"]).collect()[0]
    assert (r.table_name, r.row_count, r.null_keys, r.surplus_rows) == ("t", 5, 2, 2)
    empty = key_report(df.where("a = 99"), "e", ["a"]).collect()[0]
    assert (empty.row_count, empty.null_keys, empty.surplus_rows) == (0, 0, 0)
    assert key_report(df, "t", ["a"], min_rows=5).collect()[0].enough_rows is True
    assert key_report(df, "t", ["a"], min_rows=6).collect()[0].enough_rows is False
    assert "enough_rows" not in key_report(df, "t", ["a"]).columns


def test_schema_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "cic_id bigint, visa_type string")
    rep = {r.column_name: r for r in schema_report(df, fact_schema(["cic_id", "visa_type", "gender"]))
           .collect()}
    assert rep["cic_id"].ok and rep["cic_id"].null_count == 0
    assert rep["visa_type"].null_count == 1
    assert rep["gender"].actual_type is None and rep["gender"].ok is False


def test_drop_reasons(spark):
    rows = [(1.0, None, "10292016"), (2.0, 1.0, None), (3.0, 1.0, "D/S"), (None, 1.0, "10292016"),
            (7.0, float("nan"), "10292016"), (float("nan"), 1.0, "10292016"), (5.0, 1.0, "10292016"), (5.0, 1.0, "10292016"), (6.0, 1.0, "10/29/2016")]
    df = spark.createDataFrame(rows, "cicid double, depdate double, dtaddto string")
    got = {r.reason: r.row_count for r in drop_reasons(df).collect()}
    assert got == {"no_departure_date": 1, "no_admitted_until": 1, "invalid_departure_date": 1,
                   "invalid_admitted_until": 1, "no_cic_id": 2, "duplicate_cic_id": 1, "kept": 2}
