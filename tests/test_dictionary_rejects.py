"""Lists from one dictionary text, reject channel, sieve and salted lookup."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMALL, plan_text
from landfall import fixtures as fx
from landfall.operators.relational import (
    hot_codes,
    keep_first,
    keep_first_sieved,
    lookup_left,
    salted_lookup_left,
)
from landfall.session import scratch_uri
from landfall.sources.dictionary import read_dictionary, section_lines
from landfall.sources.rejects import MALFORMED, read_with_rejects, reject_report, sound_rows

TEXT = """libname library 'x' ;
/* A - one line */
value one
 1 = 'a' ;
 2 = 'outside'
/* TWO - in a comment
   3 = c
   3 = later
*/
VALUE $Three
\t'k'\t=\t'X, Y; Z  '
 '' = 'no key'
value one
 4 = 'd'
 1 = 'second'
;
/* words only
   5 = 'no list'
*/
value four
 6 = 'open to the end'
""".splitlines()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_sections_of_a_text(spark):
    uri = scratch_uri(spark, "text")
    spark.createDataFrame([(i, x) for i, x in enumerate(TEXT)], "i int, value string").orderBy("i").coalesce(1).select("value").write.text(uri)
    got = sorted((r.section, r.value.strip()) for r in section_lines(spark, uri).collect())
    assert got == sorted([("one", "1 = 'a' ;"), ("two", "3 = c"), ("two", "3 = later"), ("three", "'k'\t=\t'X, Y; Z  '"),
                          ("three", "'' = 'no key'"), ("one", "4 = 'd'"), ("one", "1 = 'second'"), ("four", "6 = 'open to the end'")])
    lists = read_dictionary(spark, uri, {"country": "ONE", "mode": "two", "port": "three", "state": "four", "visa": "none"})
    assert _rows(lists["country"]) == [(1, "a"), (4, "d")] and _rows(lists["mode"]) == [(3, "c")]
    assert _rows(lists["port"]) == [("k", "X", "Y; Z")] and _rows(lists["state"]) == [("6", "open to the end")]
    assert lists["visa"].collect() == []


def test_sections_over_small_splits(spark):
    """Every split gets the section that an earlier one left open."""
    uri = fx.write_dictionary(spark, SMALL)
    whole = {n: _rows(df) for n, df in read_dictionary(spark, uri).items()}
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = section_lines(spark, uri)
        assert lines.select("_block").distinct().count() > 50
        split = {n: _rows(df) for n, df in read_dictionary(spark, uri).items()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert split == whole and all(whole.values())
    # several files: a section does not go on in the next file
    two = scratch_uri(spark, "two")
    for text in (["value i94model", " 1 = 'Air'"], [" 2 = 'Sea'", "value i94visa", " 3 = x ;"]):
        spark.createDataFrame([(x,) for x in text], "value string").coalesce(1).write.mode("append").text(two)
    lists = read_dictionary(spark, two)
    assert _rows(lists["mode"]) == [(1, "Air")] and _rows(lists["visa"]) == [(3, "x")]


CONTRACT = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()),
                         T.StructField("d", T.DateType())])


def test_reject_channel(spark):
    uri = scratch_uri(spark, "csv")
    lines = ["A;N;X;D", "ok;1;1.5;2020-01-02", "few;1", "many;1;2;2020-01-01;9", "bad;x;1.0;2020-01-01", "two;1.5;y;2020-13-01",
             ";;;", "blank; 7 ;1e3;2020-01-01", '"q;uoted";2;3;2020-02-29']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(uri)
    rows = read_with_rejects(spark, uri, CONTRACT, sep=";")
    got = {r["a"]: r for r in rows.collect()}
    assert len(got) == 8
    assert got["ok"]["_reject_reasons"] == got[None]["_reject_reasons"] == got["blank"]["_reject_reasons"] == []
    assert (got["blank"]["n"], got["blank"]["x"], got["q;uoted"]["n"]) == (7, 1000.0, 2)
    assert got["few"]["_reject_reasons"] == [MALFORMED] and got["few"]["_rejected_line"] == "few;1"
    assert got["many"]["_reject_reasons"] == [MALFORMED]
    assert got["bad"]["_reject_reasons"] == ["bad_value:n"] and got["bad"]["n"] is None
    assert got["two"]["_reject_reasons"] == ["bad_value:n", "bad_value:x", "bad_value:d"]
    report = {r.reason: r.row_count for r in reject_report(rows, CONTRACT).collect()}
    assert report == {"rows": 8, "sound_rows": 4, MALFORMED: 2, "bad_value:n": 2, "bad_value:x": 1, "bad_value:d": 1}
    assert sound_rows(rows).columns == ["a", "n", "x", "d"] and sound_rows(rows).count() == 4
    # lines are judged whole whatever is selected
    assert rows.select("a", "_reject_reasons").where(F.array_contains("_reject_reasons", MALFORMED)).count() == 2


def test_sieve_gives_the_rows_of_keep_first(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 10 = 0 THEN id % 50 END AS a", "CASE WHEN id % 10 > 1 THEN id ELSE id % 7 END AS b",
                                      "id % 13 AS v", "cast(id AS string) AS s")
    want = _rows(keep_first(df, ["a", "b"], ["v"]))
    assert _rows(keep_first_sieved(df, ["a", "b"], ["v"])) == want
    assert _rows(keep_first_sieved(df, ["a", "b"], ["v"], max_rows=1)) == want  # too large a sieve: all rows
    assert keep_first_sieved(df.limit(0), ["a"]).collect() == []


def test_salted_lookup_gives_the_rows_of_lookup_left(spark):
    rows = spark.range(4000).selectExpr("CASE WHEN id % 9 < 7 THEN id % 4 WHEN id % 9 = 7 THEN id END AS code", "id % 3 AS v")
    lookup = spark.range(0, 2000, 2).selectExpr("id AS k", "concat('l', id) AS label", "id * 2 AS other")
    lookup = lookup.unionByName(lookup.where("k < 3").withColumn("label", F.lit("zz")))  # repeated keys
    assert hot_codes(rows, "code") == [0, 1, 2, 3] and hot_codes(rows.limit(0), "code") == [] and hot_codes(rows.where("code > 9"), "code") == []
    got = salted_lookup_left(rows, lookup, "code", "k")
    assert got.columns == ["code", "v", "label", "other"]
    assert _rows(got) == _rows(lookup_left(rows, lookup, "code", "k"))
    assert "SortMergeJoin" in plan_text(got)
    assert _rows(salted_lookup_left(rows.limit(0), lookup, "code", "k")) == []


@pytest.mark.parametrize("name, table", [("state", "customer"), ("port", "supplier")])
def test_list_fixtures_hold_odd_lines(spark, name, table):
    """Lines without a key and repeated keys reach the parser."""
    lines = {"state": fx.state_lines, "port": fx.port_lines}[name](spark, SMALL)
    assert lines.where("value LIKE '%NO KEY%'").count() > 0 and lines.where("value LIKE '%SECOND%'").count() > 0
