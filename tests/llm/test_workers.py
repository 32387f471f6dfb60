"""The registered queries run where workers cannot import the repository."""

import os
import subprocess
import sys

import pytest

from waymend.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


def test_queries_run_from_another_folder(tmp_path):
    root = os.path.abspath(os.path.join(os.path.dirname(__file__), "..", ".."))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from waymend.llm.queries import QUERIES\n"
        "from waymend.session import build_session\n"
        f"spark = build_session('elsewhere', 'local[4]', **{{'spark.ui.enabled': 'false', 'spark.sql.shuffle.partitions': '4', 'spark.checkpoint.dir': {str(tmp_path)!r}}})\n"
        "spark.sparkContext.setLogLevel('ERROR')\n"
        "for name, query in QUERIES.items():\n"
        f"    assert query(spark, {FOLDER!r}).count() >= 0\n"
        "    print(name, flush=True)\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0 and done.stdout.split() == list(QUERIES), done.stderr[-3000:]
