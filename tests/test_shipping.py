"""The package reaches the workers, wherever a job is started from."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidepair.functions.hashing import LinearHashes
from tidepair.operators.sketch import sketch_cells, sketch_similarity

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from tidepair.session import build_session
spark = build_session(master="local[2]", shuffle_partitions=2, extra={{"spark.ui.enabled": "false"}})
names = [n for n in ("top20_mean", "op10_ngram_join", "op5_pii") if n in entry.queries()]
print("rows", [entry.queries()[n](spark, "/root/testdata/sf0.001").count() for n in names])
"""


def test_queries_run_from_any_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=str(ROOT))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0 and "rows [20" in done.stdout, done.stderr[-2000:]


def test_closures_stay_small(spark):
    cells = sketch_cells(
        spark.range(40).select(F.current_timestamp().alias("ts"), (F.col("id") % 4).alias("sid"), "id").withColumnRenamed("id", "item"),
        LinearHashes(buckets=16),
    )
    seen = []
    found = cloudpickle.dumps

    def noted(value, *args, **kwargs):
        out = found(value, *args, **kwargs)
        seen.append(len(out))
        return out

    cloudpickle.dumps = noted
    try:
        sketch_similarity(cells, LinearHashes(buckets=16)).count()
    finally:
        cloudpickle.dumps = found
    assert seen and max(seen) < 100_000
