"""The spark-submit entry point runs a job end to end in its own process."""

import os
import subprocess
import sys

from fixtures import PEOPLE_JSON, write_lines

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_people_job_from_command_line(out):
    src = write_lines(os.path.join(out, "people.json"), PEOPLE_JSON)
    csv_out = os.path.join(out, "teens")
    proc = subprocess.run(
        [sys.executable, "-m", "meterwise", "people", src, os.path.join(out, "people.parquet"), csv_out],
        cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert proc.returncode == 0, proc.stderr[-2000:]
    parts = [f for f in os.listdir(csv_out) if f.startswith("part-")]
    text = "".join(open(os.path.join(csv_out, f)).read() for f in parts)
    assert text.strip() == "Wanda"
