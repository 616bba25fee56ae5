"""bench.py stays runnable and prints one JSON line."""

import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_DRIVER_MEMORY="1g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "np_rate", "monthly_cube"],
                         capture_output=True, text=True, env=env, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and set(result["queries"]) == {"load", "np_rate", "monthly_cube"}
    assert result["value"] > 0 and result["sf"] == 0.001
