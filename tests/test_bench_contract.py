"""bench.py prints exactly one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF001


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF001, "BENCH_RUNS": "1", "BENCH_CPUS": "2",
           "BENCH_DRIVER_MEMORY": "2g"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "q02_conditional_count"],
                         env=env, capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"q02_conditional_count"} and rec["value"] > 0
