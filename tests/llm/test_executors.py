"""Executors hold no copy of the package: every corpus query and the pipeline run from another folder."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})  # of the driver alone: workers are started without it
import __spark_entry__ as entry
from gridlens.session import build_session
spark = build_session("elsewhere", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false")
spark.sparkContext.setLogLevel("OFF")
def absent(_):
    try:
        import gridlens
        yield False
    except ImportError:
        yield True
assert spark.sparkContext.parallelize([0], 1).mapPartitions(absent).collect() == [True]
for name, query in sorted(entry.queries().items()):
    if name == "pipeline" or name.startswith("op"):
        assert query(spark, {sf!r}).count() > 0, name
print("all ran")
"""


def test_corpus_queries_run_where_the_package_is_not(sf_dir, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, sf=sf_dir)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=900)
    assert done.returncode == 0 and "all ran" in done.stdout, done.stderr[-3000:]
