"""bench.py prints one JSON line with metric, value, unit, queries and sf."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_QUERIES="basic_tags_long,slot_summary",
               BENCH_CPUS="2", BENCH_WARMUP="0")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    doc = json.loads(out[-1])
    assert doc["unit"] == "sec" and doc["sf"] == 0.001 and doc["metric"]
    assert set(doc["queries"]) == {"basic_tags_long", "slot_summary"}
    assert abs(doc["value"] - sum(doc["queries"].values())) < 0.01
