"""Every registered query against its DuckDB oracle (the driver's gate),
on the smallest generated tables."""

import pytest

import __spark_entry__ as entry
from landfall import queries as core
from conftest import SMALL
from oracle_check import compare


def test_every_query_has_an_oracle():
    assert set(core.ORACLE) == set(core.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "cic_id"


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SMALL, [name])[name]
    assert res["ok"], res
    assert res.get("types_match", True), res
