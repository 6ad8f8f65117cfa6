"""Code lists: lines are built from a shape, the tests' own keys and labels."""

import time

import pytest

from landfall.session import scratch_uri
from landfall.sources.codelists import (
    COUNTRY_PLACEHOLDERS,
    DEFAULT_MODE_ROWS,
    DEFAULT_VISA_ROWS,
    PORT_PLACEHOLDERS,
    parse_codelist,
    read_country,
    read_mode,
    read_port,
    read_state,
    read_visa,
)

COUNTRY = "   {k} =  '{l}'"
PORT = "   '{k}'\t=\t'{l}'"
STATE = "\t'{k}'='{l}'"
MODE = "\t{k} = '{l}'"
VISA = "{k} = {l}"


def _lines(shape, items):
    return [shape.format(k=k, l=l) for k, l in items]


def _write(spark, lines):
    uri = scratch_uri(spark, "codelist-test")
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(uri)
    return uri


def test_country_labels(spark):
    items = [(i, f"LAND {i}") for i in range(1, 6)]
    holders = [(100 + i, p.removesuffix(".*") + f" text {i}") for i, p in enumerate(COUNTRY_PLACEHOLDERS)]
    lines = ["﻿" + COUNTRY.format(k=0, l="FIRST"), *_lines(COUNTRY, items), "", "a heading",
             *_lines(COUNTRY + " ;", holders), COUNTRY.format(k="", l="NO KEY"), COUNTRY.format(k="x", l="NO NUMBER"),
             COUNTRY.format(k=7, l="PADDED "), COUNTRY.format(k=8, l="A = B, C (D-1)"), COUNTRY.format(k=9, l="")]
    got = {r[0]: r[1] for r in read_country(spark, _write(spark, lines)).collect()}
    assert got == {0: "FIRST", **dict(items), **{k: "NA" for k, _ in holders},
                   7: "PADDED", 8: "A = B, C (D-1)", 9: ""}


def test_port_places(spark):
    items = [("P1", "TOWN, S1      "), ("P2 ", "TOWN         "), ("P3", "TOWN, RTE. 5, S2 "), ("P4", "D''ARCY, S3")]
    holders = [(f"H{i}", p.removesuffix(".*") + f" of {i}, S9") for i, p in enumerate(PORT_PLACEHOLDERS)]
    got = {r[0]: (r[1], r[2]) for r in read_port(spark, _write(spark, _lines(PORT, items + holders))).collect()}
    assert got == {"P1": ("TOWN", "S1"), "P2": ("TOWN", None), "P3": ("TOWN", "RTE. 5"), "P4": ("DARCY", "S3"),
                   **{k: ("NA", None) for k, _ in holders}}


def test_state_mode_and_visa(spark):
    states = [(f"K{i}", f"STATE {i}") for i in range(3)]
    got = read_state(spark, _write(spark, _lines(STATE, states[:2]) + _lines(STATE + " ", states[2:])))
    assert sorted(tuple(r) for r in got.collect()) == states
    for read, shape, rows in ((read_mode, MODE, DEFAULT_MODE_ROWS), (read_visa, VISA, DEFAULT_VISA_ROWS)):
        assert sorted(tuple(r) for r in read(spark, _write(spark, _lines(shape, rows))).collect()) == rows
        assert sorted(tuple(r) for r in read(spark).collect()) == rows


@pytest.mark.parametrize("labels", [["ZULU", "ALPHA"], ["REAL", ""], ["", "REAL"], ["B", "A", "C"]])
def test_first_line_of_a_key_wins(spark, labels):
    lines = _lines(MODE, [(5, x) for x in labels]) + _lines(MODE, [(6, "OTHER")])
    assert sorted(tuple(r) for r in read_mode(spark, _write(spark, lines)).collect()) == [(5, labels[0]), (6, "OTHER")]


def test_first_line_wins_across_splits(spark):
    # a file that is read in many splits: place in the file decides, not the split's order
    n = 4000
    lines = _lines(MODE, [(i % 500, f"label {i:06d}") for i in range(n)])
    uri = _write(spark, lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(uri).rdd.getNumPartitions() > 5
        got = {r[0]: r[1] for r in read_mode(spark, uri).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: f"label {i:06d}" for i in range(500)}


def test_long_lines_parse_in_linear_time(spark):
    blanks = " " * 100_000
    lines = [blanks, blanks + "x", MODE.format(k=1, l="A" + blanks + "B"), "'" * 100_000 + "=1", MODE.format(k=2, l="OK")]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    start = time.time()
    got = [tuple(r) for r in parse_codelist(df, "k", "v", "long", COUNTRY_PLACEHOLDERS).collect()]
    assert time.time() - start < 20
    assert got == [(1, "A" + blanks + "B"), (None, "1"), (2, "OK")]


def test_keys_that_do_not_convert_are_null(spark):
    lines = spark.createDataFrame([(COUNTRY.format(k="x", l="foo"),), (COUNTRY.format(k=7, l="SEVEN"),), ("junk line",)],
                                  "value string")
    got = parse_codelist(lines, "k", "v", "long", COUNTRY_PLACEHOLDERS).collect()
    assert [tuple(r) for r in got] == [(None, "foo"), (7, "SEVEN")]
