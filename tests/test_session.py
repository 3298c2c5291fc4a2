import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from rosterlink.store import numbered, shared_folder

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = f"""
import sys
sys.path.insert(0, {REPO!r})
import __spark_entry__ as entry
from rosterlink.session import local_session
spark = local_session(2, shuffle_partitions=2)
before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.shuffle.partitions")
rows = entry.queries()["weighted_ratio"](spark, "/root/testdata/sf0.001").count()
assert before[1] == spark.conf.get("spark.sql.shuffle.partitions")
print("rows", rows)
spark.stop()
"""


def test_workers_get_the_package_whatever_the_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 1500" in done.stdout, done.stderr[-2000:]


def test_a_cluster_needs_a_shared_folder():
    """No folder of one machine stands in for the shared one."""
    undefined = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(
        master="spark://there:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: undefined)))
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_numbers_over_many_ranges(spark):
    rows = spark.range(1000).selectExpr("id * 7919 % 1000 AS n").repartition(7)
    got = numbered(rows, [F.col("n").desc()], "place").collect()
    assert sorted(r.place for r in got) == list(range(1000)) and all(r.n == 999 - r.place for r in got)
    assert numbered(rows.where("n < 0"), [F.col("n")], "place").count() == 0
