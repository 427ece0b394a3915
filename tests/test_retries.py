import os
import subprocess
import sys


def test_row_count_exact_when_tasks_are_retried():
    job = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_job.py")
    out = subprocess.run([sys.executable, job], capture_output=True, text=True, timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    observed, written, distinct = map(int, line[0].split()[1:])
    assert observed == written == distinct == 10_000
