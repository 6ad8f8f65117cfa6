"""Write the physical plan tree (and scan details) of selected queries to
docs/PLANS.md:  python tests/dump_plans.py /root/testdata/sf0.01"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SHOW = ["fact_admissions_full", "dedup_first_by_key", "lookup_left_join", "dim_airports_csv",
        "dict_port", "mart_by_visa_type", "dq_key_report", "dq_drop_reasons"]


def tree_and_scans(text: str) -> str:
    head, _, details = text.partition("\n\n\n")
    scans = [b.strip() for b in details.split("\n\n")
             if re.match(r"\(\d+\) Scan", b.strip())]
    keep = []
    for b in scans:
        keep.append("\n".join(l for l in b.splitlines()
                              if l.startswith(("(", "PushedFilters", "PartitionFilters", "ReadSchema"))))
    return head.strip() + "\n\n" + "\n\n".join(keep)


def main() -> None:
    from landfall.session import local_session
    import __spark_entry__ as entry
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    qs = entry.queries()
    out = ["# Physical plans (Spark 4.1, AQE initial plans)\n",
           "Generated by `tests/dump_plans.py`; trees plus the scan details "
           "(pushed filters, partition filters, read schema).\n"]
    for name in SHOW:
        df = qs[name](spark, sf)
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        out.append(f"## {name}\n\n```\n{tree_and_scans(text)}\n```\n")
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
