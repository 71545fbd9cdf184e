"""bench.py prints exactly one JSON line with the fields the driver reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

from .conftest import SF_SMALL

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_WORK_DIR=str(tmp_path))
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True,
                         timeout=900, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == "0.001"
    assert result["value"] > 0 and all(v >= 0 for v in result["queries"].values())
    assert set(result["shuffle_bytes"]) == set(result["queries"])
