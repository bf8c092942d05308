"""Executors don't have this package: every query runs where it can't be found."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from vitrine.llm.catalog import QUERIES
from vitrine.session import build_session

sys.path.remove({repo!r})  # what workers inherit
spark = build_session("elsewhere", "local[4]", **{{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"}})
spark.sparkContext.setLogLevel("OFF")
for name, query in QUERIES.items():
    assert query(spark, {data!r}).count() > 0, name
print("all", len(QUERIES))
"""


def test_queries_run_outside_of_the_repository(small, tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "outside.py"
    script.write_text(SCRIPT.format(repo=repo, data=small))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "all 13" in done.stdout, done.stderr[-3000:]
