"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g", BENCH_WARMUP_DIR="/nonexistent")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "value_counts", "name_id"],
                         env=env, capture_output=True, text=True, timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001" and set(rec["queries"]) == {"value_counts", "name_id"}
    assert rec["value"] == pytest.approx(sum(rec["queries"].values()), abs=0.01)
