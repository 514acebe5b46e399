"""The command line keeps the launcher's master and settings."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_launcher_settings_win():
    code = (
        "from tillpoint.__main__ import _session; s = _session(); "
        "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))"
    )
    args = "--master local[2] --conf spark.sql.shuffle.partitions=77 --conf spark.ui.enabled=false pyspark-shell"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": args, "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "GOT local[2] 77" in out.stdout, out.stderr[-500:]
