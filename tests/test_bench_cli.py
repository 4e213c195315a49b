"""Driver-facing scripts: bench prints one JSON line; the job CLI checks stages."""

import json
import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RANKER="0")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], cwd=str(tmp_path),
                         env=env, capture_output=True, text=True, timeout=900)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout[-2000:] + out.stderr[-2000:]
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["value"] > 0 and rec["sf"] == 0.001
    assert {"prepare", "preprocess", "features", "dataset"} <= set(rec["queries"])


def test_job_cli_rejects_unknown_stage():
    from rankbeam.plans import job

    with pytest.raises(SystemExit):
        job.main(["raw", "out", "--stages", "prepare", "bogus"])
