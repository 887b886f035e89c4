"""Late rows as a side output: every row once, over batches, restarts and failures."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import tidepair.streaming.late as module
from tests.test_sketch import START
from tidepair.session import shared_folder
from tidepair.streaming.late import pane_end, read_late, read_on_time, read_record, start_routing
from tidepair.streaming.replay import count_late, replay
from tidepair.streaming.similarity import run_for

SCHEMA = "ts timestamp, sid long, item long"
DAY = timedelta(days=1)


def at(hours):
    return START + timedelta(hours=hours)


PARTS = [
    [(at(h), 1, h) for h in range(72)],
    [(at(2), 1, 100)] * 3 + [(at(71.5), 1, 101)] * 2 + [(None, 1, 102), (at(80), 2, 103)],
    [(at(120), 1, 104), (at(47.99), 2, 105), (at(72), 2, 106)],
    [(at(72), 3, 107), (at(96), 3, 108), (at(-50), 3, 109)],
]


def by_hand(parts, delay=1):
    late, on_time, records, last = [], [], [], None
    for number, rows in enumerate(parts):
        mark = None if last is None else last - timedelta(hours=delay)
        behind = []
        for ts, *rest in rows:
            end = None if ts is None else START + ((ts - START) // DAY + 1) * DAY
            (behind if end and mark and end <= mark else on_time).append((number, ts, *rest))
        late += behind
        times = [r[0] for r in rows if r[0]]
        records.append((number, len(rows), len(behind), max(times, default=None), mark))
        last = max([t for t in (last, *times) if t], default=None)
    return late, on_time, records


def plain(rows):
    naive = [tuple(v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v for v in r) for r in rows]
    return sorted(naive, key=str)


def land(spark, landing, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)


def run(spark, landing, out):
    stream = spark.readStream.schema(SCHEMA).parquet(landing)
    return run_for(start_routing(stream, out, "1 day", "1 hour", once=True))


def check(spark, out, parts):
    late, on_time, records = by_hand(parts)
    schema = spark.createDataFrame([], SCHEMA).schema
    order = ["routed_batch", "ts", "sid", "item"]
    assert plain(read_late(spark, out, schema).select(*order).collect()) == plain(late)
    assert plain(read_on_time(spark, out, schema).select(*order).collect()) == plain(on_time)
    record = read_record(spark, out).orderBy("batch")
    got = record.select("batch", "rows", "late", "last", "watermark").collect()
    assert plain(got) == plain(records)
    assert [r.rows_so_far for r in record.collect()] == [sum(len(p) for p in parts[: i + 1]) for i in range(len(parts))]
    return late


def test_rows_of_several_batches_are_routed_once(spark):
    landing, out = shared_folder(spark, "landing"), shared_folder(spark, "out")
    for i, part in enumerate(PARTS):
        land(spark, landing, part)
        run(spark, landing, out)
        run(spark, landing, out)  # a restart that finds nothing new
        check(spark, out, PARTS[: i + 1])
    assert len(check(spark, out, PARTS)) == 6


@pytest.mark.parametrize("when", ["before the record", "after the record"])
def test_a_failed_batch_is_repeated_whole(spark, monkeypatch, when):
    landing, out = shared_folder(spark, "landing"), shared_folder(spark, "out")
    land(spark, landing, PARTS[0])
    run(spark, landing, out)
    land(spark, landing, PARTS[1])
    write = module.write_record

    def fail(record, path):
        if when == "after the record":
            write(record, path)
        raise OSError("lost")

    monkeypatch.setattr(module, "write_record", fail)
    with pytest.raises(Exception, match="lost"):
        run(spark, landing, out)
    monkeypatch.undo()
    if when == "before the record":
        check(spark, out, PARTS[:1])  # rows without a record are not read
    run(spark, landing, out)
    check(spark, out, PARTS[:2])


def test_late_rows_are_those_that_the_aggregation_drops(spark):
    rows = [(*r, p) for p, part in enumerate(PARTS) for r in part if r[0]]
    df = spark.createDataFrame(rows, f"{SCHEMA}, part int")
    dropped = {r.pane_end: r.late for r in count_late(df, F.col("part"), "1 day", "1 hour").collect() if r.late}
    schema = df.schema
    _, out = replay(df, F.col("part"), lambda s, out: start_routing(s, out, "1 day", "1 hour", once=True))
    found = read_late(spark, out, schema).groupBy(pane_end("1 day").alias("end")).count().collect()
    ends = {r.end: r["count"] for r in found}
    assert dropped == {end: ends[end] for end in dropped} and dropped


def test_no_rows_and_clashing_columns(spark):
    out = shared_folder(spark, "out")
    empty = spark.createDataFrame([], SCHEMA)
    _, out = replay(empty, F.lit(0), lambda s, out: start_routing(s, out, "1 day", "1 hour", once=True))
    assert read_late(spark, out, empty.schema).count() == read_on_time(spark, out, empty.schema).count() == 0
    # the file without rows was a batch
    assert [tuple(r) for r in read_record(spark, out).collect()] == [(0, 0, 0, None, None, 0)]
    with pytest.raises(ValueError, match="routed_side"):
        start_routing(empty.withColumn("Routed_Side", F.lit(1)), out)
