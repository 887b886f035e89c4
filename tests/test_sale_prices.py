from __future__ import annotations

from pyspark.sql import functions as F

from tidepair.operators.align import sparse_vectors
from tidepair.operators.cosine import one_value
from tidepair.plans.fixtures import sale_prices


def test_tasks_grow_with_the_rows(spark, tmp_path, monkeypatch):
    """What a task groups is bounded: more rows are more tasks, and a series stays in one."""
    monkeypatch.setattr("tidepair.session.ROWS_PER_TASK", 50)
    rows = [(s, d, float(s + d)) for s in range(100) for d in range(10) for _ in range(2)]
    rows += [(None, 3, 1.0), (None, 3, 2.0), (7, None, 5.0)]
    items = spark.createDataFrame(rows, "l_suppkey bigint, day int, l_extendedprice double")
    shipped = F.timestamp_seconds(F.col("day") * 86400 + 3600).cast("timestamp_ntz")
    items.withColumn("l_shipdate", shipped).drop("day").write.parquet(f"{tmp_path}/lineitem.parquet")
    panel = sale_prices(spark, str(tmp_path))
    found = {(r.series, None if r.date is None else str(r.date)): r.value for r in panel.collect()}
    want = {(str(s), f"1970-01-{d + 1:02}"): 2.0 * (s + d) for s in range(100) for d in range(10)}
    assert found == want | {(None, "1970-01-04"): 3.0, ("7", None): 5.0}
    vectors = sparse_vectors(one_value(panel), "series", "value").withColumn("part", F.spark_partition_id())
    parts = vectors.groupBy("part").agg(F.sum(F.size("days")).alias("rows")).collect()
    assert sum(r.rows for r in parts) == 1000
    # four partitions, merged to fewer, would hold 250 and more each
    assert len(parts) > 16 and max(r.rows for r in parts) < 200
    # sums, single values and vectors are made where the rows were dealt to
    assert vectors._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
