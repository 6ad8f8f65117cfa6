import datetime as dt
import re

from conftest import plan_text
from landfall.contracts import RAW_ADMISSIONS_COLUMNS, fact_schema
from landfall.plans.fact import admissions
from landfall.session import scratch_uri
from landfall.sources.admissions import load_raw_admissions
from landfall.sources.codelists import default_mode, default_visa

RAW_SCHEMA = ", ".join(
    f"{c} {'string' if c in ('i94port', 'i94addr', 'visapost', 'dtaddto', 'gender', 'airline', 'fltno', 'visatype') else 'double'}"
    for c in RAW_ADMISSIONS_COLUMNS)


def _row(cicid, mon=4.0, arr=20573.0, mode=1.0, dep=20580.0, visa=2.0, dta="10292016"):
    vals = {"cicid": cicid, "i94yr": 2016.0, "i94mon": mon, "i94cit": 209.0, "i94res": 209.0,
            "i94port": "NYC", "arrdate": arr, "i94mode": mode, "i94addr": "NY", "depdate": dep,
            "i94bir": 37.0, "i94visa": visa, "visapost": "TKY", "biryear": 1979.0, "dtaddto": dta,
            "gender": "F", "airline": "JL", "admnum": 55425779230.0, "fltno": "00004", "visatype": "WT"}
    return tuple(vals[c] for c in RAW_ADMISSIONS_COLUMNS)


ROWS = [
    _row(1.0),                                   # kept
    _row(2.0, dep=None),                         # no departure
    _row(3.0, dta="D/S"),                        # not a date
    _row(4.0, dta="02302016"),                   # 8 digits, impossible day
    _row(None),                                  # no key
    _row(1.0, mon=5.0),                          # duplicate key: loses to the first row
    _row(7.0, arr=None, mode=7.0, visa=float("nan")),  # unknown codes, no arrival
    _row(8.0, dta="10/29/2016"),                 # slashes are stripped
    _row(9.0, dep=float("nan")),                 # a departure that is no date
    _row(float("nan")),                          # a key that is no number
    _row(10.0, mon=1.0, dta="02302016"),         # loses to the row with a date, though it sorts first
    _row(10.0, mon=9.0),
]


def _raw(spark):
    uri = scratch_uri(spark, "fact-test")
    spark.createDataFrame(ROWS, RAW_SCHEMA).coalesce(2).write.parquet(uri)
    return load_raw_admissions(spark, uri, "parquet")


def test_fact_rules(spark):
    fact = admissions(_raw(spark), default_mode(spark), default_visa(spark),
                      lookups_bounded=True, lookups_unique=True)
    assert fact.schema == fact_schema() or [f.dataType for f in fact.schema.fields] == \
        [f.dataType for f in fact_schema().fields]
    assert fact.columns == fact_schema().fieldNames()
    got = {r.cic_id: r for r in fact.collect()}
    assert sorted(got) == [1, 7, 8, 10]
    assert got[10].month_of_entry == 9
    one = got[1]
    assert one.month_of_entry == 4
    assert one.arrival_date == dt.date(2016, 4, 29)
    assert one.departure_date == dt.date(2016, 5, 6)
    assert one.person_allowed_date == dt.date(2016, 10, 29)
    assert (one.arrival_mode, one.visa_code) == ("Air", "Pleasure")
    assert one.admission_number == 55425779230
    assert (got[7].arrival_date, got[7].arrival_mode, got[7].visa_code) == (None, None, None)
    assert got[8].person_allowed_date == dt.date(2016, 10, 29)


def test_fact_plan_is_native(spark):
    fact = admissions(_raw(spark), default_mode(spark), default_visa(spark),
                      lookups_bounded=True, lookups_unique=True)
    plan = plan_text(fact)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert len(re.findall(r"^\(\d+\) BroadcastHashJoin", plan, re.M)) == 2
    # the null predicates reach the Parquet scan
    assert "IsNotNull(depdate)" in plan and "IsNotNull(dtaddto)" in plan
    # the admitted-until text is converted once per row
    assert plan.count("\\W+") == 1
    # one shuffle (the de-duplication); both lookups are broadcast
    assert len(re.findall(r"^\(\d+\) Exchange$", plan, re.M)) == 1
    assert re.search(r"\) WindowGroupLimit\n.*\nArguments: .*row_number\(\), 1, Partial", plan)


def test_fact_from_csv_text_equals_fact_from_doubles(spark):
    # the CSV variant of the source delivers every number as text ("20573.0",
    # "5.542577923E10", "NaN"); the fact must not depend on it
    src = spark.createDataFrame(ROWS, RAW_SCHEMA)
    uri = scratch_uri(spark, "fact-csv")
    src.coalesce(1).write.option("header", "true").csv(uri)
    from_csv = admissions(load_raw_admissions(spark, uri, "csv"), default_mode(spark),
                          default_visa(spark), lookups_bounded=True, lookups_unique=True)
    from_doubles = admissions(_raw(spark), default_mode(spark), default_visa(spark),
                              lookups_bounded=True, lookups_unique=True)
    assert sorted(map(tuple, from_csv.collect())) == sorted(map(tuple, from_doubles.collect()))
    assert from_csv.count() == 4


def test_keys_above_2_53_stay_apart(spark):
    from pyspark.sql import functions as F

    big = 2 ** 53
    base = _raw(spark).where("cicid = 1 AND i94mon = 4").limit(1)
    for make in (lambda k: F.lit(k), lambda k: F.lit(str(k)), lambda k: F.lit(f"{k}.0")):
        raw = base.withColumn("cicid", make(big)).unionByName(base.withColumn("cicid", make(big + 1)))
        fact = admissions(raw, default_mode(spark), default_visa(spark), True, True)
        assert sorted(r.cic_id for r in fact.collect()) == [big, big + 1]
        from landfall.operators.quality import drop_reasons

        reasons = {r.reason: r.row_count for r in drop_reasons(raw).collect()}
        assert (reasons["kept"], reasons["duplicate_cic_id"]) == (2, 0)


def test_lookup_branches_agree_on_a_hot_null(spark):
    """Broadcast and shuffle joins give the same fact rows: four codes and a
    null code that most rows carry."""
    from pyspark.sql import functions as F

    from landfall.operators.relational import lookup_left

    facts = spark.range(0, 20_000).select("id", F.when(F.col("id") % 5 == 0, F.col("id") % 4).alias("code"))
    lookup = spark.createDataFrame([(0, "a"), (1, "b"), (2, None), (2, "c"), (9, "z")], "k long, label string")
    small = lookup_left(facts, lookup, "code", "k")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup_left(facts, lookup, "code", "k", max_broadcast_rows=1)
        plan = plan_text(large)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        a, b = small.collect(), large.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan_text(small)
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr) and len(a) == 20_000
    assert {r.label for r in a} == {None, "a", "b", "c"}
