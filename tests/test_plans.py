"""Plan guards over every registered query: native expressions only, no
all-pairs joins, no window pulling a whole key group into one task."""

import re

import pytest

from conftest import SMALL, plan_text
from landfall import queries as core

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query_plan_is_native_and_skew_safe(spark, name):
    plan = plan_text(core.QUERIES[name](spark, SMALL))
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, (name, bad)
    # every window is a keep-first: group-limited on the map side before its shuffle
    windows = len(re.findall(r"^\(\d+\) Window$", plan, re.M))
    partial_limits = len(re.findall(r"row_number\(\), 1, Partial", plan))
    assert partial_limits >= windows, (name, windows, partial_limits)
    if name.startswith("mart_"):
        # read-backs prune partition directories
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan, name
