"""Summarise the physical plan of every extract on the production layout.

For each extract: shuffles (Exchange), join strategies, partition filters and pushed filters of
each scan, and whether anything leaves whole-stage codegen for Python.

Usage: python tools/plan_summary.py [sf_dir]   (writes the layout to a fresh scratch folder)
"""

from __future__ import annotations

import re
import sys
import tempfile
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from bench import EXTRACTS, extract, prepare  # noqa: E402
from caseload import Cohorts, Scope  # noqa: E402
from caseload.plans.batch import extract_all  # noqa: E402
from caseload.session import spark_session  # noqa: E402


def summary(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"(Exchange \w+|BroadcastExchange|ShuffleExchange)", plan)
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)[^\n]*?(LeftSemi|Inner|LeftOuter|LeftAnti)?", plan)
    scans = re.findall(r"FileScan parquet [^\n]*?Location: \S+ \S*?/([\w]+)\][^\n]*?PartitionFilters: (.*?), PushedFilters: (\[[^\]]*\])", plan)
    python = [w for w in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas") if w in plan]
    lines = [f"  shuffles: {sum(1 for e in exchanges if e != 'BroadcastExchange')}, broadcasts: {exchanges.count('BroadcastExchange')}",
             f"  joins: {[' '.join(j).strip() for j in joins]}"]
    for table, part, pushed in scans:
        lines.append(f"  scan {table}: partition {part} pushed {pushed}")
    if python:
        lines.append(f"  PYTHON: {python}")
    return "\n".join(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = spark_session("local[8]", 16)
    data = prepare(spark, sf_dir, tempfile.mkdtemp(prefix="plans-", dir="/tmp"))
    scopes = {"provider": Scope.provider("NATION_3"), "region": Scope.region("AFRICA"),
              "national": Scope.national(0.25, 42)}
    for level, scope in scopes.items():
        for kind in EXTRACTS:
            c = Cohorts(data, scope, 2024 if kind == "aae" else 2000, factor_years=(1999, 2000))
            print(f"{level}_{kind}\n{summary(extract(c, kind))}")
    reqs = {
        "provider": spark.createDataFrame([("a", "NATION_3", 2000), ("b", "NATION_5", 1999)], "request_id string, code string, fyear int"),
        "region": spark.createDataFrame([("a", "AFRICA", 2000), ("b", "ASIA", 1999)], "request_id string, code string, fyear int"),
        "national": spark.createDataFrame([("a", 2000, 0.25, 1), ("b", 1999, 0.5, 2)], "request_id string, fyear int, sample_rate double, seed long"),
    }
    for level, req in reqs.items():
        for kind in EXTRACTS:
            print(f"batch_{level}_{kind}\n{summary(extract_all(data, req, kind, level, factor_years=(1999, 2000)))}")
    spark.stop()


if __name__ == "__main__":
    main()
