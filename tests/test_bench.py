"""bench.py prints exactly one JSON line with the keys the driver records."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2", BENCH_QUERIES="missing_surface_by_type")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env,
        capture_output=True,
        text=True,
        timeout=600,
        check=True,
    )
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    report = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(report)
    assert report["unit"] == "sec" and report["sf"] == 0.001
    assert set(report["queries"]) == {"missing_surface_by_type"}
