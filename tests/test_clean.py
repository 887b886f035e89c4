from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidepair.functions.calendar import WeekdayCalendar
from tidepair.operators.clean import (
    calendar_grid,
    clean_series,
    clean_series_relational,
    complete_series,
    fill_gaps,
    incomplete_series,
    missing_slots,
    on_calendar,
)
from tidepair.operators.select import describe_series, limit_series

CALENDAR = WeekdayCalendar(date(2024, 1, 1), date(2024, 1, 12))
DAYS = [
    CALENDAR.start + timedelta(days=i)
    for i in range(12)
    if (CALENDAR.start + timedelta(days=i)).weekday() < 5
]
SCHEMA = "series string, date date, value double, row_id long"


def panel(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA)


def full(name, skip=(), value=1.0):
    return [(name, d, value + i) for i, d in enumerate(DAYS) if i not in skip]


def as_dict(df):
    return {(r.series, r.date): r.value for r in df.collect()}


def expected_clean(rows, max_gap):
    """Brute force over Python rows."""
    kept = {}
    for i, (name, day, value) in enumerate(rows):
        if name is not None and day is not None and day in DAYS:
            kept.setdefault((name, day), value)
    result = {}
    for name in {n for n, _ in kept}:
        filled = {}
        for i, day in enumerate(DAYS):
            for back in range(max_gap + 1):
                if i - back >= 0 and (name, DAYS[i - back]) in kept:
                    filled[day] = kept[name, DAYS[i - back]]
                    break
        if len(filled) == len(DAYS) and None not in filled.values():
            result.update({(name, d): v for d, v in filled.items()})
    return result


EDGES = [
    *full("whole"),
    *full("gap1", skip={4}),
    *full("gap2", skip={4, 5}),
    *full("monday", skip={5}),
    *full("last", skip={9}),
    *full("first", skip={0}),
    *[(n, d, None if i == 3 else v) for i, (n, d, v) in enumerate(full("nullprice"))],
    # the day after a null price is missing: filled from the null, so dropped
    *[(n, d, None if d == DAYS[3] else v) for n, d, v in full("nullthengap", skip={4})],
    *full("twice"),
    ("twice", DAYS[2], 99.0),
    *full("weekend"),
    ("weekend", date(2024, 1, 6), 5.0),
    ("weekend", date(2023, 12, 29), 5.0),
    ("onlyweekend", date(2024, 1, 6), 5.0),
    *[(None, d, v) for _, d, v in full("x")],
    ("baddate", None, 1.0),
]


@pytest.mark.parametrize("max_gap", [0, 1, 2, 3])
@pytest.mark.parametrize("form", [clean_series, clean_series_relational])
def test_edge_rows(spark, form, max_gap):
    got = as_dict(form(panel(spark, EDGES), CALENDAR, max_gap, "row_id"))
    assert got == expected_clean(EDGES, max_gap)
    names = {n for n, _ in got}
    assert ("gap1" in names) == (max_gap >= 1) and ("gap2" in names) == (max_gap >= 2)
    assert names.isdisjoint({"first", "nullprice", "nullthengap", "onlyweekend", "baddate", None})


def test_monday_gap_is_filled_from_friday_and_first_duplicate_is_kept(spark):
    got = as_dict(clean_series(panel(spark, EDGES), CALENDAR, 1, "row_id"))
    assert got["monday", DAYS[5]] == got["monday", DAYS[4]] == 5.0
    assert got["twice", DAYS[2]] == 3.0


@pytest.mark.parametrize("seed", range(4))
def test_random_panels(spark, seed):
    rng = random.Random(seed)
    rows = []
    for n in range(40):
        for day in DAYS:
            for _ in range(rng.choice([0, 1, 1, 1, 1, 1, 1, 2, 3]) if rng.random() < 0.9 else 1):
                rows.append((f"s{n}", day, None if rng.random() < 0.01 else rng.random()))
    rng.shuffle(rows)
    for gap in (1, 2):
        want = expected_clean(rows, gap)
        assert as_dict(clean_series(panel(spark, rows), CALENDAR, gap, "row_id")) == want
        assert as_dict(clean_series_relational(panel(spark, rows), CALENDAR, gap, "row_id")) == want


def test_clean_is_idempotent_and_complete(spark):
    once = clean_series(panel(spark, EDGES), CALENDAR, 1, "row_id")
    assert as_dict(clean_series(once, CALENDAR)) == as_dict(once)
    counts = once.groupBy("series").count().collect()
    assert counts and all(r["count"] == CALENDAR.size for r in counts)


def test_grid_missing_and_fill_steps(spark):
    present = on_calendar(panel(spark, EDGES), CALENDAR, "row_id")
    grid = {(r.series, r.date) for r in calendar_grid(present, CALENDAR).collect()}
    have = {(r.series, r.date) for r in present.collect()}
    missing = {(r.series, r.date) for r in missing_slots(present, CALENDAR).collect()}
    assert grid == {(n, d) for n in {n for n, _ in have} for d in DAYS}
    assert missing == grid - have
    filled = fill_gaps(present, CALENDAR, 1)
    assert {(r.series, r.date) for r in filled.collect()} == grid
    assert {(r.series, r.date) for r in filled.where("filled").collect()} == missing
    bad = {r.series for r in incomplete_series(filled).collect()}
    good = {r.series for r in complete_series(filled).collect()}
    assert bad == {"gap2", "first", "nullprice", "nullthengap"}
    assert good == {n for n, _ in grid} - bad


def test_empty_panel(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert clean_series(empty, CALENDAR).count() == 0
    assert clean_series_relational(empty, CALENDAR).count() == 0
    assert limit_series(empty, 5).count() == 0
    assert describe_series(empty).first().row_count == 0


def test_hot_series_leaves_one_row_per_day(spark):
    """One series has most of the rows; each of its days is one row after the
    first aggregate, before rows are brought together by series."""
    hot = spark.range(200_000).select(
        F.lit("hot").alias("series"),
        F.date_add(F.lit(CALENDAR.start), (F.col("id") % 12).cast("int")).alias("date"),
        F.col("id").cast("double").alias("value"),
        F.col("id").alias("row_id"),
    )
    got = as_dict(clean_series(hot.unionByName(panel(spark, full("cold"))), CALENDAR, 1, "row_id"))
    assert len(got) == 2 * CALENDAR.size
    assert got["hot", DAYS[3]] == 3.0


def test_limit_orders_by_number_nulls_first_then_name(spark):
    names = ["10.A", "9.B", "9.A", "x.A", "100.C", "y"]
    rows = panel(spark, [(n, DAYS[0], 1.0) for n in names for _ in range(2)])
    for n, want in ((2, {"x.A", "y"}), (4, {"x.A", "y", "9.A", "9.B"}), (9, set(names))):
        got = limit_series(rows, n)
        assert {r.series for r in got.collect()} == want
        assert got.count() == 2 * len(want)


def test_describe(spark):
    row = describe_series(panel(spark, [("a", DAYS[0], 1.0), ("b", DAYS[1], 3.0), ("b", DAYS[2], None)]))
    got = row.first()
    assert (got.row_count, got.series_count, got.value_count) == (3, 2, 2)
    assert (got.value_mean, got.value_min, got.value_max) == (2.0, 1.0, 3.0)
    assert got.value_stddev == pytest.approx(2**0.5)
