import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from landfall.functions import (
    admitted_until,
    region_state,
    remove_quotes,
    sas_day_to_date,
    strip_nonword,
    to_na,
    trim_ws,
)
from landfall.functions.cleaning import to_number


def _one_col(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_sas_day_to_date(spark):
    df = _one_col(spark, [20573.0, None, float("nan"), 0.0, -1.0, 1e12, 2936549.0, 2936550.0,
                          -715509.0, -715510.0], "double")
    got = [r[0] for r in df.select(sas_day_to_date("v")).collect()]
    assert got == [dt.date(2016, 4, 29), None, None, dt.date(1960, 1, 1),
                   dt.date(1959, 12, 31), None, dt.date(9999, 12, 31), None,
                   dt.date(1, 1, 1), None]


def test_admitted_until_edge_values(spark):
    vals = ["10292016", "10/29/2016", "D/S", "00000000", "99999999", "02302016", None,
            "1029201", "102920161", "AB292016"]
    df = _one_col(spark, vals, "string")
    got = [r[0] for r in df.select(admitted_until("v")).collect()]
    assert got == [dt.date(2016, 10, 29), dt.date(2016, 10, 29), None, None, None, None, None,
                   None, None, None]


def test_strip_nonword(spark):
    df = _one_col(spark, ["10/29/2016", "D/S", "a_b-c d", None], "string")
    assert [r[0] for r in df.select(strip_nonword("v")).collect()] == ["10292016", "DS", "a_bcd", None]


def test_region_state(spark):
    df = _one_col(spark, ["US-CA", "US", None, "US-", "US-NY-X"], "string")
    assert [r[0] for r in df.select(region_state("v")).collect()] == ["CA", None, None, "", "NY"]


def test_trim_quotes_and_placeholders(spark):
    words = ["one", "two words", "three  more"]
    df = _one_col(spark, [f"\t'{w}' " for w in words] + [f" \r\n{w}\x0b\f" for w in words] + ["''a'b''", None], "string")
    got = [tuple(r) for r in df.select(trim_ws(remove_quotes("v")), remove_quotes("v"), trim_ws("v")).collect()]
    assert [r[0] for r in got] == words + words + ["ab", None]
    assert [r[2] for r in got[:3]] == [f"'{w}'" for w in words]
    assert got[6][1] == "ab"
    # fixed values: the placeholder patterns; the labels around them are the test's own
    pats = ["No Country.*", "INVALID.*", "Collapsed.*"]
    heads = [p.removesuffix(".*") for p in pats]
    labels = _one_col(spark, [f"{h}{w}" for h in heads for w in words] + words + [f"x {heads[0]}"], "string")
    got = [r[0] for r in labels.select(to_na(F.col("v"), pats)).collect()]
    assert got == ["NA"] * 9 + words + ["x NA"]


BIG = 2 ** 53


def test_whole_numbers_are_exact(spark):
    values = [BIG, BIG + 1, -BIG - 1, 9223372036854775807, 0]
    for kind, make in (("bigint", int), ("decimal(25,2)", Decimal), ("string", str),
                       ("string", lambda v: f"{v}.0"), ("string", lambda v: f" {v}.75 ")):
        df = _one_col(spark, [make(v) for v in values], kind)
        assert [r[0] for r in df.select(to_number("v", "bigint")).collect()] == values, kind


def test_numbers_that_are_none(spark):
    df = _one_col(spark, ["NaN", "x", "", None, "1e400", "99999999999999999999", "5.5E3", "-1.9", "1E2"], "string")
    assert [r[0] for r in df.select(to_number("v", "bigint")).collect()] == [None] * 6 + [5500, -1, 100]
    df = _one_col(spark, [float("nan"), float("inf"), 1e19, 2.9, -0.5], "double")
    assert [r[0] for r in df.select(to_number("v", "bigint")).collect()] == [None, None, None, 2, 0]
    assert [r[0] for r in df.select(to_number("v", "int")).collect()] == [None, None, None, 2, 0]
