"""The package outside its folder: shipped to executors, and the shared folder that clusters must name."""

import os
import subprocess
import sys
import tempfile
from types import SimpleNamespace

import pytest

from textsieve import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.append({ROOT!r})
from textsieve.session import get_spark
import __spark_entry__ as E
spark = get_spark("foreign", master="local[2]", shuffle_partitions=2)
for name in ("best_block", "song_tree_ingest", "op3_simhash", "pipeline"):
    if name in E.queries():
        print("ROWS", E.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_html_queries_run_from_a_foreign_folder():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="textsieve-test-"), env=env, capture_output=True, text=True, timeout=300)
    counts = [int(x.split()[0]) for x in out.stdout.split("ROWS")[1:]]
    assert len(counts) >= 2 and min(counts) > 0, out.stderr[-2000:]


def session_stub(master, checkpoint=None):
    conf = {"spark.checkpoint.dir": checkpoint} if checkpoint else {}
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: conf.get("set"), setCheckpointDir=lambda d: conf.update(set=d))
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__))


def test_a_cluster_must_name_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.ensure_checkpoint_dir(session_stub(master))
    assert session.ensure_checkpoint_dir(session_stub("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert os.path.isdir(session.ensure_checkpoint_dir(session_stub("local[2]")))
