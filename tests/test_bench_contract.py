"""bench.py prints exactly one JSON line with the fields the round driver reads."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "blank_pii",
                          "mask_text_documents"], env=env, capture_output=True, text=True,
                         timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["metric"] and rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"blank_pii", "mask_text_documents"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3)
    assert "errors" not in rec
