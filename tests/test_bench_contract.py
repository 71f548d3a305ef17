"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys
from pathlib import Path


def test_bench_prints_one_json_line():
    root = Path(__file__).resolve().parents[1]
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2", "BENCH_RUNS": "1",
           "BENCH_WARMUP": "0", "BENCH_QUERIES": "q30_scheduled_window,q18_visit_map_both_windows"}
    out = subprocess.run([sys.executable, str(root / "bench.py")], capture_output=True, text=True,
                         timeout=600, env=env)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"q30_scheduled_window", "q18_visit_map_both_windows"}
    assert abs(result["value"] - sum(result["queries"].values())) < 0.01
