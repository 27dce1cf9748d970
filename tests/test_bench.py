"""bench.py prints exactly one JSON line with the contract fields."""

import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_bench_contract():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="episode_dropoff,dq_unique", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    doc = json.loads(out[0])
    assert doc["unit"] == "sec" and doc["sf"] == 0.001 and set(doc["queries"]) == {"episode_dropoff", "dq_unique"}
    assert doc["value"] == pytest.approx(sum(doc["queries"].values()), abs=1e-3) and "errors" not in doc
