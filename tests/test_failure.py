"""A task of the job dies once and is retried; the committed target has each row once."""

import re
import subprocess
import sys
from pathlib import Path


def test_write_survives_a_failed_task(tmp_path):
    script = Path(__file__).with_name("failure_run.py")
    out = subprocess.run(
        [sys.executable, str(script), "/root/testdata/sf0.001", str(tmp_path / "target"), str(tmp_path / "ckpt"),
         str(tmp_path / "failed-once")],
        capture_output=True, text=True, timeout=600)
    m = re.search(r"RESULT expected=(\d+) written=(\d+) distinct=(\d+)", out.stdout)
    assert m, out.stdout[-2000:] + out.stderr[-4000:]
    expected, written, distinct = map(int, m.groups())
    assert expected > 0
    assert written == distinct == expected
    assert (tmp_path / "failed-once").exists()      # the first attempt really died
