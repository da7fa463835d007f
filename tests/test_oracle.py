"""Every registered query against its DuckDB oracle SQL at sf0.001."""

import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_all_queries_match_oracle():
    r = subprocess.run([sys.executable, os.path.join(ROOT, "scripts", "check_oracle.py"), SF_SMALL],
                       capture_output=True, text=True, timeout=1800)
    lines = [ln for ln in r.stdout.splitlines() if ln.strip()]
    assert lines and lines[-1] == "bad 0", "\n".join(lines[-60:]) + r.stderr[-2000:]
