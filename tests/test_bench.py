"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_REPEAT="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"),
                          "rating_histogram", "sql_range"],
                         capture_output=True, text=True, env=env, timeout=600, check=True)
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001"
    assert set(rec["queries"]) == {"rating_histogram", "sql_range"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3)


def test_explain_cli_prints_plans():
    out = subprocess.run([sys.executable, "-m", "tessera.plans.explain", SF_SMALL,
                          "item_popularity", "sql_range"],
                         capture_output=True, text=True, cwd=ROOT, timeout=600, check=True)
    assert out.stdout.count("== Physical Plan ==") == 2
    assert "TakeOrderedAndProject" in out.stdout and "PushedFilters" in out.stdout
