"""Task functions must not need the package on the worker's path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from seriesloom.session import local_session
from seriesloom.plans import QUERIES
spark = local_session(2)
print("rows", QUERIES["ses_grid"](spark, "/root/testdata/sf0.001").count(), QUERIES["adf_test"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180
    )
    assert "rows 100 10" in done.stdout, done.stderr[-2000:]
