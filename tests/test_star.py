import datetime

from conftest import SMALL
from landfall import fixtures as fx
from landfall.plans import star
from landfall.session import scratch_uri


def test_star_build_end_to_end(spark):
    inp = fx.write_star_inputs(spark, SMALL)
    out = scratch_uri(spark, "star-test")
    uris = star.run(spark, inp, out)
    assert set(uris) == set(star.TABLE_PATHS)
    rep = {r.table_name: r for r in star.published_key_report(spark, uris).collect()}
    for name, r in rep.items():
        assert r.row_count > 0, name
        assert r.null_keys == 0 and r.surplus_rows == 0, (name, r)
    # the three fact layouts hold the same rows
    assert rep["visatype"].row_count == rep["arrival_date"].row_count == rep["citizenship"].row_count
    facts = [spark.read.parquet(uris[t]).select("cic_id", "arrival_date", "visa_type")
             for t in ("visatype", "arrival_date", "citizenship")]
    assert facts[0].exceptAll(facts[1]).count() == 0
    assert facts[1].exceptAll(facts[2]).count() == 0


def test_cli_runs_the_star(spark, capsys):
    import json

    from landfall.__main__ import main
    inp = fx.write_star_inputs(spark, SMALL)
    out = scratch_uri(spark, "star-cli")
    main(["--airports-csv", inp.airports_csv, "--demographics-csv", inp.demographics_csv,
          "--country-list", inp.country_list, "--port-list", inp.port_list,
          "--state-list", inp.state_list, "--admissions", inp.admissions, "--out", out, "--report",
          "--admissions-option", "mergeSchema=false"])
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    uris = lines[0]
    counted = {(x["table_name"], x["metric"]): x["value"] for x in lines if "metric" in x}
    assert counted["admissions", "duplicate_cic_id"] > 0 and counted["admissions", "kept"] == counted["visatype", "rows"]
    assert all(x["ok"] for x in lines if "ok" in x) and sum("ok" in x for x in lines) > 60
    assert all(x["enough_rows"] for x in lines if "enough_rows" in x)
    assert set(uris) == set(star.TABLE_PATHS)
    assert spark.read.parquet(uris["country"]).count() == fx.table(spark, SMALL, "customer").count()


def test_fact_with_list_files_matches_built_in_lookups(spark):
    from dataclasses import replace

    from pyspark.sql import functions as F
    base = fx.write_star_inputs(spark, SMALL)
    mode_uri = scratch_uri(spark, "mode-list")
    spark.createDataFrame([("\t1 = 'Air'",), ("\t2 = 'Sea'",), ("\t3 = 'Land'",), ("\t3 = 'Land'",),
                           ("\t9 = 'Not reported'",)], "value string").write.text(mode_uri)
    visa_uri = scratch_uri(spark, "visa-list")
    spark.createDataFrame([("1 = Business",), ("2 = Pleasure",), ("3 = Student",)],
                          "value string").write.text(visa_uri)
    with_files = star.build_fact(spark, replace(base, mode_list=mode_uri, visa_list=visa_uri))
    built_in = star.build_fact(spark, base)
    assert with_files.count() == built_in.count()
    assert with_files.exceptAll(built_in).count() == 0
    assert with_files.where(F.col("arrival_mode") == "Land").count() > 0


def test_single_table_jobs(spark):
    inp = fx.write_star_inputs(spark, SMALL)
    out = scratch_uri(spark, "star-single")
    uri = star.publish_country(spark, inp.country_list, out)
    assert uri.endswith("country/country.parquet")
    assert spark.read.parquet(uri).count() == fx.table(spark, SMALL, "customer").count()
    layouts = star.publish_admissions(spark, inp.admissions, out)
    assert sorted(layouts) == ["arrival_date", "citizenship", "visatype"]
    assert len({spark.read.parquet(u).count() for u in layouts.values()}) == 1


def test_key_report_does_not_retype_partition_values(spark):
    """Cities 01 and 1 are two keys."""
    from landfall.contracts import DEMOGRAPHICS, LAYOUTS
    from landfall.plans.marts import write_mart

    rows = [(city, "S", 1.0, 1, 1, 2, 0, 0, 2.0, "ST", "R", 1) for city in ("01", "1")]
    uri = scratch_uri(spark, "demographics")
    write_mart(spark.createDataFrame(rows, DEMOGRAPHICS), uri, LAYOUTS["demographics"])
    r = star.published_key_report(spark, {"demographics": uri}).first()
    assert (r.row_count, r.surplus_rows) == (2, 0)


def test_scratch_is_released(spark):
    import os

    from landfall import session

    uri = scratch_uri(spark, "released")
    spark.range(3).write.parquet(uri)
    kept = list(session._SCRATCH[:-1])
    session._SCRATCH[:] = [uri]
    try:
        assert session.release_scratch(spark) == 1
        assert not os.path.exists(uri.removeprefix("file:"))
    finally:
        session._SCRATCH[:] = kept


def test_dimension_layouts_can_be_stored(spark, tmp_path):
    """Columns that differ only by case are written and read again."""
    from landfall import queries, session
    session.release_scratch(spark)
    rows = {"customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
                         [(i, f"Customer {i}", i % 9, "ABC"[i % 3]) for i in range(1, 60)]),
            "supplier": ("s_suppkey long, s_nationkey int", [(i, i % 9) for i in range(1, 30)]),
            "orders": ("o_orderkey long, o_custkey long, o_orderdate date, o_orderstatus string, o_orderpriority string",
                       [(1, 1, datetime.date(1996, 1, 2), "F", "1-URGENT")])}
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    before = spark.conf.get("spark.sql.caseSensitive")
    try:
        got = queries.QUERIES["star_dimension_layouts"](spark, str(tmp_path))
        got.write.parquet(f"{tmp_path}/out")
        again = spark.read.parquet(f"{tmp_path}/out")
        assert again.columns == got.columns and {"state", "State", "city", "City"} <= set(again.columns)
        assert again.where("State IS NOT NULL AND state IS NULL").select("table_name").distinct().collect() == [("demographics",)]
        assert again.where("city IS NOT NULL").select("table_name").distinct().collect() == [("portOfEntry",)]
        assert {r["table_name"]: r["count"] for r in again.groupBy("table_name").count().collect()}["country"] == 59
    finally:
        session.release_scratch(spark)
    assert spark.conf.get("spark.sql.caseSensitive") == before
