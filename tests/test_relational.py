import re

from pyspark.sql import functions as F

from conftest import plan_text
from landfall.operators.relational import fits_broadcast, keep_first, lookup_left, union_codes


def test_keep_first_order_and_ties(spark):
    rows = [(1, 3, "b"), (1, 1, "z"), (1, 1, "a"), (2, None, "q"), (2, 5, "r"), (None, 9, "n1"),
            (None, 8, "n2")]
    df = spark.createDataFrame(rows, "k int, o int, x string")
    got = sorted(keep_first(df, ["k"], ["o"]).collect(), key=lambda r: (r.k is None, r.k))
    # first by o, then by x; nulls of the order column last; null keys form one group
    assert [tuple(r) for r in got] == [(1, 1, "a"), (2, 5, "r"), (None, 8, "n2")]


def test_keep_first_is_deterministic_under_reshuffle(spark):
    base = spark.range(0, 5000).select((F.col("id") % 37).alias("k"), (F.col("id") % 11).alias("o"),
                                       F.col("id").alias("x"))
    a = keep_first(base, ["k"], ["o"]).orderBy("k").collect()
    b = keep_first(base.repartition(13, "x").orderBy(F.rand(7)), ["k"], ["o"]).orderBy("k").collect()
    assert a == b
    assert len(a) == 37


def test_keep_first_hot_key_is_partially_aggregated(spark):
    # one key holds a third of all rows: the aggregate reduces it before the exchange
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
                                      .alias("k"), F.col("id").alias("v"))
    out = keep_first(df, ["k"], ["v"])
    plan = plan_text(out)
    # each map task keeps its first row per key before the exchange
    assert re.search(r"\) WindowGroupLimit\n.*\nArguments: .*row_number\(\), 1, Partial", plan)
    hot = out.where("k = -1").collect()
    assert [tuple(r) for r in hot] == [(-1, 0)]
    assert out.count() == 20001


def test_union_codes_single_scan(spark):
    df = spark.createDataFrame([("a", "I1", "L1"), ("b", None, "L2"), ("c", "I3", None), ("d", None, None)],
                               "ident string, iata_code string, local_code string")
    out = union_codes(df, ["iata_code", "local_code"], "port_code")
    assert out.columns == ["ident", "port_code", "_src"]
    assert sorted(tuple(r) for r in out.collect()) == [
        ("a", "I1", 0), ("a", "L1", 1), ("b", "L2", 1), ("c", "I3", 0)]
    plan = plan_text(out)
    assert len(re.findall(r"^\(\d+\) (Scan|LocalTableScan)", plan, re.M)) == 1
    assert "Union" not in plan


def test_lookup_left_no_row_multiplication(spark):
    facts = spark.createDataFrame([(1, 3), (2, 3), (3, 7), (4, None)], "id int, code int")
    lookup = spark.createDataFrame([(3, "Land"), (3, "Land"), (1, "Air")], "c long, label string")
    out = lookup_left(facts, lookup, "code", "c", [("label", "mode")])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 3, "Land"), (2, 3, "Land"), (3, 7, None),
                                                      (4, None, None)]
    assert "BroadcastHashJoin" in plan_text(out)


def test_lookup_left_over_bound_is_not_hinted(spark):
    facts = spark.range(0, 100).select(F.col("id").alias("code"))
    lookup = spark.range(0, 50).select(F.col("id").alias("c"), F.col("id").cast("string").alias("l"))
    assert not fits_broadcast(lookup, max_rows=10)
    assert fits_broadcast(lookup, max_rows=100)
    assert not fits_broadcast(lookup, max_rows=100, max_bytes=10)
    out = lookup_left(facts, lookup, "code", "c", max_broadcast_rows=10)
    # no broadcast hint from us (Spark may still choose one from its statistics)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        initial = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in initial or "ShuffledHashJoin" in initial
        assert out.where("l is not null").count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
