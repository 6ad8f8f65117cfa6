import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from landfall.session import local_session
    s = local_session("*", 8)
    # small test data: let AQE keep several tasks so partitioned writes fan out
    s.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    yield s
    s.stop()


def plan_text(df) -> str:
    """Physical plan as text (formatted explain)."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
