from __future__ import annotations

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest

from tidepair.functions.calendar import WeekdayCalendar
from tidepair.functions.vectors import cosine, register_cosine
from tidepair.operators.align import align_to_calendar, series_vectors
from tidepair.operators.cosine import (
    cosine_aligned,
    cosine_aligned_broadcast,
    cosine_vectors,
    top_matches,
)
from tidepair.operators.pairs import pair_series, supported_pair_series, supported_pairs, topic_pairs
from tidepair.operators.topk import best_per_measure, top_k
from tidepair.plans.match import match_series

CALENDAR = WeekdayCalendar(date(2024, 1, 1), date(2024, 1, 19))
DAYS = [
    CALENDAR.start + timedelta(days=i)
    for i in range(19)
    if (CALENDAR.start + timedelta(days=i)).weekday() < 5
]


def series_rows(rng, names, holes=0.0, low=0.1):
    return [
        (n, d, float(rng.uniform(low, 10)))
        for n in names
        for d in DAYS
        if rng.random() >= holes
    ]


def visit_rows(rng, topics, holes=0.0, low=0):
    return [
        (t, d, int(rng.integers(low, 50)))
        for t in topics
        for d in DAYS
        if rng.random() >= holes
    ]


def frames(spark, series, visits):
    return (
        spark.createDataFrame(series, "series string, date date, value double"),
        spark.createDataFrame(visits, "topic string, date date, visit int"),
    )


def brute_force(series, visits):
    x, y = {}, {}
    for n, d, v in series:
        x.setdefault(n, {})[d] = v
    for t, d, v in visits:
        y.setdefault(t, {})
        y[t][d] = y[t].get(d, 0) + v
    result = {}
    for n, xs in x.items():
        for a in y:
            for b in y:
                if not a < b:
                    continue
                days = xs.keys() & y[a].keys() & y[b].keys()
                if not days:
                    continue
                scores = []
                for f in (lambda p, q: (p + q) / 2, min, max):
                    ys = {d: f(y[a][d], y[b][d]) for d in days}
                    norm = math.sqrt(sum(xs[d] ** 2 for d in days)) * math.sqrt(
                        sum(v * v for v in ys.values())
                    )
                    scores.append(sum(xs[d] * ys[d] for d in days) / norm if norm else None)
                result[n, a, b] = scores
    return result


def scores(df):
    rows = df.collect()
    got = {(r.series, r.topic1, r.topic2): [r.cos_mean, r.cos_min, r.cos_max] for r in rows}
    assert len(got) == len(rows)
    return got


def assert_close(got, want):
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values, abs=1e-9), key


NAMES = [f"{i}.S" for i in range(23)]
TOPICS = [f"topic {c}" for c in "qwertyu"]


@pytest.mark.parametrize("holes", [0.0, 0.3])
@pytest.mark.parametrize("low", [0, -20])
def test_all_forms_agree_with_brute_force(spark, holes, low):
    rng = np.random.default_rng(7)
    s, v = series_rows(rng, NAMES, holes), visit_rows(rng, TOPICS, holes, low)
    v += v[:5]  # repeated rows are added up
    series, visits = frames(spark, s, v)
    want = brute_force(s, v)
    assert_close(scores(cosine_aligned(series, visits)), want)
    assert_close(scores(cosine_aligned(series, visits)), want)
    assert_close(scores(cosine_aligned(series, visits, topics_per_block=3)), want)
    assert_close(scores(cosine_aligned(series, visits, topics_per_block=1)), want)
    assert_close(scores(cosine_aligned_broadcast(series, visits)), want)
    assert_close(scores(cosine_aligned_broadcast(series, visits, broadcast_bytes=0)), want)
    assert_close(scores(cosine_vectors(series, visits, CALENDAR)), want)


def test_weekend_visits_are_left_out(spark):
    rng = np.random.default_rng(1)
    s, v = series_rows(rng, NAMES[:3]), visit_rows(rng, TOPICS[:3], low=1)
    weekend = [(t, date(2024, 1, 6), 1000) for t in TOPICS[:3]]
    series, visits = frames(spark, s, v + weekend)
    want = brute_force(s, v)
    assert_close(scores(cosine_aligned(series, align_to_calendar(visits, CALENDAR))), want)
    assert_close(scores(cosine_vectors(series, visits, CALENDAR)), want)


def test_zero_norm_is_null_and_not_ranked(spark):
    rng = np.random.default_rng(2)
    s = [("zero", d, 0.0) for d in DAYS] + series_rows(rng, ["1.S"])
    v = visit_rows(rng, ["a", "b"], low=1) + [("c", d, 0) for d in DAYS]
    series, visits = frames(spark, s, v)
    for got in (
        scores(cosine_aligned(series, visits)),
        scores(cosine_aligned_broadcast(series, visits)),
        scores(cosine_vectors(series, visits, CALENDAR)),
    ):
        assert_close(got, brute_force(s, v))
        assert got["zero", "a", "b"] == [None, None, None]
        assert got["1.S", "a", "c"][1] is None and got["1.S", "a", "c"][2] is not None
    ranked = top_k(top_matches(series, visits, 5), "min", 5).collect()
    assert [(r.series, r.topic1, r.topic2) for r in ranked] == [("1.S", "a", "b")]


def test_one_topic_or_nothing_gives_no_rows(spark):
    rng = np.random.default_rng(3)
    s, v = series_rows(rng, NAMES[:2]), visit_rows(rng, TOPICS[:1])
    for a, b in ((s, v), ([], v), (s, [])):
        series, visits = frames(spark, a, b)
        assert cosine_aligned(series, visits).count() == 0
        assert cosine_aligned(series, visits).count() == 0
        assert cosine_aligned_broadcast(series, visits).count() == 0
        assert cosine_vectors(series, visits, CALENDAR).count() == 0
        assert top_matches(series, visits).count() == 0


def test_a_scaled_series_has_cosine_one(spark):
    rng = np.random.default_rng(4)
    v = visit_rows(rng, ["a", "b"], low=1)
    a, b = ({d: n for t, d, n in v if t == x} for x in "ab")
    s = [("mean", d, 3.5 * (a[d] + b[d]) / 2) for d in DAYS]
    s += [("min", d, 0.1 * min(a[d], b[d])) for d in DAYS]
    s += [("max", d, 7.0 * max(a[d], b[d])) for d in DAYS]
    got = scores(cosine_aligned(*frames(spark, s, v)))
    for i, name in enumerate(("mean", "min", "max")):
        assert got[name, "a", "b"][i] == pytest.approx(1.0)
        assert all(-1 - 1e-12 <= c <= 1 + 1e-12 for c in got[name, "a", "b"])


@pytest.mark.parametrize("block", [None, 2])
@pytest.mark.parametrize("digits", [None, 2])
def test_top_matches_equal_the_sort_of_all_scores(spark, block, digits):
    """With ties: copies of the same series, and rounding to two places."""
    rng = np.random.default_rng(5)
    one = series_rows(rng, ["x"])
    s = series_rows(rng, NAMES) + [(f"copy{i}", d, v) for i in range(30) for _, d, v in one]
    series, visits = frames(spark, s, visit_rows(rng, TOPICS, low=1))
    matches = top_matches(series, visits, 20, digits=digits, topics_per_block=block).cache()
    every = cosine_aligned(series, visits).cache()
    report = best_per_measure(matches, 20, digits).collect()
    for measure in ("mean", "min", "max"):
        want = [tuple(r) for r in top_k(every, measure, 20, digits).collect()]
        got = [tuple(r) for r in top_k(matches, measure, 20, digits).collect()]
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
        mine = sorted((r.position, r.series, r.topic1, r.topic2) for r in report if r.measure == measure)
        assert mine == [(i + 1, *w[:3]) for i, w in enumerate(want)]


def test_pairs(spark):
    rng = np.random.default_rng(6)
    v = visit_rows(rng, TOPICS, 0.2)
    visits = frames(spark, [], v + [(None, DAYS[0], 3)])[1]
    want = {(a, b) for a in TOPICS for b in TOPICS if a < b}
    for blocks in (None, 1, 3):
        rows = topic_pairs(visits, blocks).collect()
        assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    value = {(t, d): n for t, d, n in v}
    expected = {
        (a, b, d, (value[a, d] + value[b, d]) / 2, min(value[a, d], value[b, d]), max(value[a, d], value[b, d]))
        for a, b in want
        for d in DAYS
        if (a, d) in value and (b, d) in value
    }
    rows = pair_series(visits).collect()
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected)


def test_series_vectors_put_nulls_in_missing_slots(spark):
    rows = [("a", DAYS[1], 1.0), ("a", DAYS[4], 2.0), ("b", DAYS[0], 3.0)]
    rows += [("full", d, float(i)) for i, d in enumerate(DAYS)]
    df = spark.createDataFrame(rows, "series string, date date, value double")
    got = {r.name: r.vector for r in series_vectors(df, CALENDAR).collect()}
    n = len(DAYS)
    assert got["a"] == [None, 1.0, None, None, 2.0] + [None] * (n - 5)
    assert got["b"] == [3.0] + [None] * (n - 1)
    assert got["full"] == [float(i) for i in range(n)]


def test_cosine_function_in_sql_and_as_expression(spark):
    register_cosine(spark)
    df = spark.createDataFrame(
        [([1.0, 2.0], [2.0, 4.0]), ([1.0, None], [2.0, 5.0]), ([0.0, 0.0], [1.0, 1.0])],
        "x array<double>, y array<double>",
    )
    df.createOrReplaceTempView("arrays")
    by_sql = [r.c for r in spark.sql("SELECT cosine_similarity(x, y) AS c FROM arrays").collect()]
    by_expression = [r.c for r in df.select(cosine(df.x, df.y).alias("c")).collect()]
    assert by_sql == by_expression == [pytest.approx(1.0), pytest.approx(1.0), None]


def test_embeddings_agree_with_numpy(spark):
    em = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    pairs = em.selectExpr(
        "cast(embedding as array<double>) AS x",
        "cast(lead(embedding) OVER (ORDER BY vec_id) AS array<double>) AS y",
    ).where("y IS NOT NULL")
    rows = pairs.withColumn("c", cosine(pairs.x, pairs.y)).collect()
    assert len(rows) == 499
    for r in rows:
        x, y = np.array(r.x), np.array(r.y)
        assert r.c == pytest.approx(x @ y / np.linalg.norm(x) / np.linalg.norm(y))


def test_whole_job(spark):
    rng = np.random.default_rng(8)
    s = series_rows(rng, NAMES) + [("3.S", DAYS[0], 0.0)]
    s = [r for r in s if not (r[0] == "5.S" and r[1] in DAYS[3:6])]  # a long gap
    v = visit_rows(rng, TOPICS, low=1)
    series, visits = frames(spark, s, v)
    report = match_series(series, visits, CALENDAR, max_series=8, k=4).collect()
    assert len(report) == 12
    assert {r.series for r in report} <= {f"{i}.S" for i in range(9)} - {"5.S"}


def test_odd_values_and_repeated_rows_are_the_same_in_all_forms(spark):
    """NaN and infinity count as missing, of repeated rows the least value stays."""
    rng = np.random.default_rng(11)
    s = series_rows(rng, NAMES[:4])
    s += [("nan", d, float("nan")) for d in DAYS] + [("zero", d, 0.0) for d in DAYS]
    s += [("inf", d, float("inf") if d == DAYS[0] else 1.0 + d.day) for d in DAYS]
    s += [("twice", d, v) for d in DAYS for v in (3.0 + d.day, 90.0)]
    series, visits = frames(spark, s, visit_rows(rng, TOPICS, low=1))
    want = scores(cosine_aligned(series, visits))
    assert_close(scores(cosine_aligned(series, visits, topics_per_block=1)), want)
    assert_close(scores(cosine_aligned_broadcast(series, visits)), want)
    assert_close(scores(cosine_vectors(series, visits, CALENDAR)), want)
    assert not any(name == "nan" for name, *_ in want)
    plain, _ = frames(spark, [("twice", d, 3.0 + d.day) for d in DAYS], [])
    assert_close(scores(cosine_aligned(plain, visits)), {k: v for k, v in want.items() if k[0] == "twice"})
    assert all(r.similarity == r.similarity for m in ("mean", "min", "max") for r in top_k(cosine_aligned(series, visits), m).collect())


def test_nan_scores_are_not_ranked(spark):
    rows = [("a", "x", "y", float("nan")), ("b", "x", "y", 0.5), ("c", "x", "y", None)]
    every = spark.createDataFrame(rows, "series string, topic1 string, topic2 string, cos_mean double")
    assert [r.series for r in top_k(every, "mean").collect()] == ["b"]
    marked = every.selectExpr("'mean' AS measure", "series", "topic1", "topic2", "cos_mean AS similarity")
    assert [r.series for r in best_per_measure(marked).collect()] == ["b"]


def test_pairs_by_support(spark):
    rng = random.Random(8)
    rows = [(f"t{t}", date(2024, 1, 1) + timedelta(rng.randrange(30)), 1.0) for t in range(40) for _ in range(rng.randrange(1, 12))]
    rows += [("t0", None, 1.0), (None, date(2024, 1, 1), 1.0), *(("every", date(2024, 1, 1) + timedelta(d), 2.0) for d in range(30))]
    visits = spark.createDataFrame(rows, "topic string, date date, visit double")
    every = {}
    for r in pair_series(visits).collect():
        every.setdefault((r["topic1"], r["topic2"]), []).append(tuple(r))
    for least in (1, 3, 6):
        want = {k: len(v) for k, v in every.items() if len(v) >= least}
        assert {(r["topic1"], r["topic2"]): r["days"] for r in supported_pairs(visits, least).collect()} == want
        found = supported_pair_series(visits, least).collect()
        assert sorted(map(tuple, found)) == sorted(x for k, v in every.items() if k in want for x in v)
    with pytest.raises(ValueError):
        supported_pairs(visits, 0)


def test_pairs_by_support_list_no_other_pairs(spark):
    """All topics share two days and groups of three share more: only those are looked at."""
    first = date(2024, 1, 1)
    rows = [(f"t{t}", first + timedelta(d), 1.0) for t in range(300) for d in (0, 1)]
    rows += [(f"t{t}", first + timedelta(10 + 4 * (t // 3) + d), 1.0) for t in range(300) for d in range(4)]
    found = supported_pairs(spark.createDataFrame(rows, "topic string, date date, visit double"), 3)
    assert found.count() == 300
    joined = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in joined and "Cross" not in joined
