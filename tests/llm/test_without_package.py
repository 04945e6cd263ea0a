"""Executors that do not have the package run every query whose functions travel with the job."""

import os
import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as registry
from tidemark.session import local_session
spark = local_session(4, "without")
for name in {names!r}:
    rows = registry.queries()[name](spark, "/root/testdata/sf0.001").count()
    print(name, rows, flush=True)
"""
NAMES = ["op3_simhash", "op9_neighbours", "op10_top_k", "op11_links", "op12_alignment", "op13_trie"]


def test_queries_from_an_empty_folder(tmp_path):
    repo = str(Path(__file__).resolve().parents[2])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = CODE.format(repo=repo, names=NAMES)
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert ran.returncode == 0, ran.stderr[-3000:]
    assert [line.split()[0] for line in ran.stdout.splitlines()] == NAMES
