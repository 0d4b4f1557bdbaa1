import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_task_retry_leaves_snapshot_and_metrics_unchanged():
    # Own process: task retries need a local[N,F] master, fixed at start-up.
    out = subprocess.run(
        [sys.executable, os.path.join(HERE, "resilience", "retry_job.py"), "/root/testdata/sf0.001/events.parquet"],
        capture_output=True, text=True, timeout=600,
    )
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert line, out.stdout[-2000:] + out.stderr[-2000:]
    res = json.loads(line[-1])
    assert res["same_rows"] and res["n_rows"] > 0
    assert res["same_metrics"], res
    assert "injected task failure" in out.stderr  # the retry really happened
