"""bench.py prints one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from support import ROOT, SF001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2",
               BENCH_QUERIES="sql_like_join,lloyd_3pass,row_index")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, cwd="/")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"sql_like_join", "lloyd_3pass", "row_index"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3) or abs(
        rec["value"] - sum(rec["queries"].values())) < 1e-6
