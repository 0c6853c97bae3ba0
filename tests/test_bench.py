"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="ace_counts_by_appliance,top_identities_high_perms")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    rec = json.loads(out[-1])
    assert rec["metric"] == "total_query_sec" and rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) >= {"ace_counts_by_appliance", "top_identities_high_perms"}
    assert rec["value"] > 0 and rec["n_queries"] == 2 and not rec["errors"]
