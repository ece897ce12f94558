"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4", BENCH_REPEAT="1",
               BENCH_WHOLE_JOB="0")
    done = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True,
                          timeout=900, check=True, text=True)
    lines = [line for line in done.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["metric"] and result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == set(entry.queries())
    assert abs(result["value"] - sum(result["queries"].values())) < 1e-3
