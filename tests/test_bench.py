"""bench.py prints one JSON line with the driver's fields (smoke run at sf0.001)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_SKIP_RDD="1",
               BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"calls_to_cells", "raw_docs_to_cells", "contacts_to_cells"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3)
