"""bench.py prints one JSON line with every headline query (smallest scale, one run)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_REPEAT": "1", "BENCH_WARMUP": "0", "BENCH_CPUS": "4",
           "BENCH_QUERIES": "lake"}
    out = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True, text=True,
                         timeout=900, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["metric"] == "outbreak_report_sec" and result["unit"] == "sec" and result["sf"] == 0.001
    assert result["value"] == result["queries"]["outbreak_report"] > 0
    assert {"report_from_table", "stream_curate", "curate_parquet", "mixed_lanes_scan"} <= set(result["queries"])
