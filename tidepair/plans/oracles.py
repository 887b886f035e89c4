"""For each registered query, the same result in SQL over the given tables.

Written independently of the Spark plans (ranks, grids and self-joins spelled
out), so that a match means something.
"""

from __future__ import annotations

from tidepair.functions.hashing import MERSENNE_PRIME_31
from tidepair.plans.queries import (
    DEFAULT_HASHES,
    DIGITS,
    FEED_THRESHOLD,
    HASHES,
    LATE_DAYS,
    LATE_ITEM,
    LIMIT,
    LONG_THRESHOLD,
    MURMUR,
    PART_DAYS,
    SHARED_DAYS,
    WIDE,
    WIDE_THRESHOLD,
    WINDOW_THRESHOLD,
)

_PRICES = """
prices AS (
    SELECT CAST(user_id AS VARCHAR) || '.U' AS series, CAST(ts AS DATE) AS date, value, event_id
    FROM events),
calendar AS (
    SELECT CAST(t.d AS DATE) AS date
    FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 1 DAY)) AS d
          FROM events) AS t
    WHERE isodow(t.d) <= 5),
in_range AS (SELECT p.* FROM prices p JOIN calendar c ON c.date = p.date),
one_row AS (
    SELECT series, date, value
    FROM (SELECT *, row_number() OVER (PARTITION BY series, date ORDER BY event_id) AS rn
          FROM in_range) AS ranked
    WHERE rn = 1),
grid AS (
    SELECT s.series, c.date FROM (SELECT DISTINCT series FROM one_row) s CROSS JOIN calendar c)
"""


def _filled(name: str, max_gap: int) -> str:
    """The grid with gaps filled from up to ``max_gap`` weekdays back."""
    order = "ORDER BY date"
    days_back = " ".join(
        f"WHEN {step} <= {max_gap} AND b{step}.value IS NOT NULL THEN b{step}.value"
        for step in (1, 2)
    )
    return f"""
numbered AS (SELECT date, row_number() OVER ({order}) AS k FROM calendar),
{name} AS (
    SELECT g.series, g.date,
           CASE WHEN o.series IS NOT NULL THEN o.value {days_back} END AS value,
           o.series IS NULL AS filled
    FROM grid g
    JOIN numbered n ON n.date = g.date
    LEFT JOIN one_row o ON o.series = g.series AND o.date = g.date
    LEFT JOIN numbered n1 ON n1.k = n.k - 1
    LEFT JOIN one_row b1 ON b1.series = g.series AND b1.date = n1.date
    LEFT JOIN numbered n2 ON n2.k = n.k - 2
    LEFT JOIN one_row b2 ON b2.series = g.series AND b2.date = n2.date)
"""


_CLEAN = (
    _PRICES
    + ","
    + _filled("filled_grid", 1)
    + """,
clean AS (
    SELECT series, date, value FROM filled_grid
    WHERE series NOT IN (SELECT series FROM filled_grid WHERE value IS NULL))
"""
)

_VISITS = """
visits AS (
    SELECT event_type AS topic, CAST(ts AS DATE) AS date, CAST(count(*) AS DOUBLE) AS visit
    FROM events GROUP BY 1, 2)
"""

_PAIRS = """
pairs AS (
    SELECT a.topic AS topic1, b.topic AS topic2, a.date AS date,
           (a.visit + b.visit) / 2 AS mean,
           least(a.visit, b.visit) AS min,
           greatest(a.visit, b.visit) AS max
    FROM weekday_visits a JOIN weekday_visits b ON a.date = b.date AND a.topic < b.topic)
"""

_WEEKDAY_VISITS = """
weekday_visits AS (SELECT v.* FROM visits v JOIN calendar c ON c.date = v.date)
"""

_SALES = """
clean AS (
    SELECT CAST(l_suppkey AS VARCHAR) AS series, CAST(l_shipdate AS DATE) AS date,
           sum(l_extendedprice) AS value
    FROM lineitem GROUP BY 1, 2),
weekday_visits AS (
    SELECT CAST(l_linenumber AS VARCHAR) AS topic, CAST(l_shipdate AS DATE) AS date,
           CAST(count(*) AS DOUBLE) AS visit
    FROM lineitem GROUP BY 1, 2)
"""


_PART_DAYS = """
part_days AS (
    SELECT CAST(l_partkey AS VARCHAR) AS topic, CAST(l_shipdate AS DATE) AS date,
           CAST(count(*) AS DOUBLE) AS visit
    FROM lineitem GROUP BY 1, 2)
"""


def _scores(series: str = "clean") -> str:
    def cosine(m: str) -> str:
        return (
            f"round(sum(s.value * p.{m}) / nullif(sqrt(sum(s.value * s.value))"
            f" * sqrt(sum(p.{m} * p.{m})), 0), {DIGITS}) AS cos_{m}"
        )

    return f"""
scores AS (
    SELECT s.series, p.topic1, p.topic2, {cosine('mean')}, {cosine('min')}, {cosine('max')}
    FROM {series} s JOIN pairs p ON p.date = s.date
    GROUP BY s.series, p.topic1, p.topic2)
"""


_COSINE = ", ".join([_CLEAN, _VISITS, _WEEKDAY_VISITS, _PAIRS, _scores()])

_FIRST = f"""
first_names AS (
    SELECT series FROM (SELECT DISTINCT series FROM clean) AS names
    ORDER BY TRY_CAST(split_part(series, '.', 1) AS HUGEINT) NULLS FIRST, series
    LIMIT {LIMIT}),
chosen AS (SELECT * FROM clean WHERE series IN (SELECT series FROM first_names))
"""

_HASHES = "hashes(f, a, b) AS (VALUES " + ", ".join(
    f"({f}, {a}, {b})" for f, (a, b) in enumerate(zip(HASHES.multipliers, HASHES.offsets))
) + ")"

_FEED = """
feed AS (
    SELECT ts, user_id AS sid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item
    FROM events)
"""



def _bucket(buckets: int) -> str:
    return (
        f"CAST((((h.a * (e.item % {MERSENNE_PRIME_31}) + h.b) % {MERSENNE_PRIME_31})"
        f" % {buckets}) AS INTEGER)"
    )


_BUCKET = _bucket(HASHES.buckets)


def _cells(bucket: str) -> str:
    return f"""
cells AS (
    SELECT e.sid, CAST(h.f AS INTEGER) AS f, {bucket} AS v, count(*) AS n
    FROM feed e CROSS JOIN hashes h GROUP BY 1, 2, 3)
"""


_CELLS = _cells(_BUCKET)

_PURCHASES = """
feed AS (
    SELECT o_custkey AS sid, l_partkey AS item
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""

_SKETCH = ", ".join([_HASHES, _FEED, _CELLS])

# Murmur3 (32 bit, seed 42) of a 64-bit integer, in arithmetic on numbers below
# 2^64, one step per subquery.  Fixed values: the constants of the hash.
_M = 4294967296


def _times(x: str, factor: int) -> str:
    return f"CAST((CAST({x} AS HUGEINT) * {factor}) % {_M} AS BIGINT)"


def _rotate(x: str, bits: int) -> str:
    return f"(({x} * {2**bits}) % {_M} + {x} // {2 ** (32 - bits)})"


def _murmur3_cells() -> str:
    steps = ["SELECT DISTINCT item FROM feed"]

    def step(**columns: str) -> None:
        named = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
        steps.append(f"SELECT *, {named} FROM ({steps[-1]}) AS t{len(steps)}")

    step(w0=f"((item % {_M}) + {_M}) % {_M}")
    step(w1=f"((((item - w0) // {_M}) % {_M}) + {_M}) % {_M}")
    state = "42"
    for i, word in enumerate(("w0", "w1")):
        step(**{f"k{i}": _times(word, 3432918353)})
        step(**{f"r{i}": _rotate(f"k{i}", 15)})
        step(**{f"x{i}": f"xor(CAST({state} AS BIGINT), {_times(f'r{i}', 461845907)})"})
        step(**{f"s{i}": _rotate(f"x{i}", 13)})
        step(**{f"h{i}": f"({_times(f's{i}', 5)} + 3864292196) % {_M}"})
        state = f"h{i}"
    step(f0=f"xor({state}, CAST(8 AS BIGINT))")
    step(f1="xor(f0, f0 // 65536)")
    step(f2=_times("f1", 2246822507))
    step(f3="xor(f2, f2 // 8192)")
    step(f4=_times("f3", 3266489909))
    step(full_hash="xor(f4, f4 // 65536)")
    seeds = ", ".join(f"({f}, {seed})" for f, seed in enumerate(MURMUR.seeds))
    w = MURMUR.buckets
    return f"""
seeds(f, seed) AS (VALUES {seeds}),
hashed AS (
    SELECT item, CAST(f AS INTEGER) AS f,
           CASE WHEN mixed >= {_M // 2} THEN mixed - {_M} ELSE mixed END AS signed
    FROM (SELECT item, f, xor(full_hash, CAST(seed AS BIGINT)) AS mixed
          FROM ({steps[-1]}) AS last CROSS JOIN seeds) AS all_functions),
cells AS (
    SELECT e.sid, h.f, CAST(((h.signed % {w}) + {w}) % {w} AS INTEGER) AS v, count(*) AS n
    FROM feed e JOIN hashed h ON h.item = e.item GROUP BY 1, 2, 3)
"""


_PRODUCTS = """
products AS (
    SELECT x.sid AS sid1, y.sid AS sid2, x.f AS f, CAST(sum(x.n * y.n) AS BIGINT) AS product
    FROM cells x JOIN cells y ON x.f = y.f AND x.v = y.v AND x.sid > y.sid
    GROUP BY 1, 2, 3),
alike AS (
    SELECT sid1, sid2, min(product) AS similarity FROM products
    GROUP BY 1, 2 HAVING count(*) = 5)
"""

_WINDOWS = f"""
window_cells AS (
    SELECT CAST(date_trunc('day', e.ts) AS TIMESTAMP) + to_days(CAST(w.ahead AS INTEGER))
               AS window_end,
           e.sid, CAST(h.f AS INTEGER) AS f, {_BUCKET} AS v, count(*) AS n,
           count(*) FILTER (WHERE w.ahead = 1) AS fresh
    FROM feed e CROSS JOIN hashes h CROSS JOIN generate_series(1, 5) AS w(ahead)
    GROUP BY 1, 2, 3, 4),
window_products AS (
    SELECT x.window_end, x.sid AS sid1, y.sid AS sid2, x.f AS f,
           CAST(sum(x.n * y.n) AS BIGINT) AS product
    FROM window_cells x JOIN window_cells y
      ON x.window_end = y.window_end AND x.f = y.f AND x.v = y.v AND x.sid > y.sid
    GROUP BY 1, 2, 3, 4),
window_similar AS (
    SELECT window_end, sid1, sid2, min(product) AS similarity FROM window_products
    GROUP BY 1, 2, 3 HAVING count(*) = 5 AND min(product) > {WINDOW_THRESHOLD}),
watermark AS (SELECT max(ts) - INTERVAL 1 HOUR AS closed FROM events)
"""

_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {1}"
_DATE = "CAST(date AS VARCHAR) AS date"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ", ".join(parts) + select


def _top(measure: str) -> str:
    return _with(
        _COSINE,
        select=f"""
    SELECT series, topic1, topic2, cos_{measure} AS similarity FROM scores
    WHERE cos_{measure} IS NOT NULL
    ORDER BY similarity DESC, series, topic1, topic2 LIMIT 20""",
    )


def _top_items(measure: str) -> str:
    visits = """
item_days AS (
    SELECT json_extract_string(props, '$.k') AS topic, CAST(ts AS DATE) AS date, count(*) AS n
    FROM events GROUP BY 1, 2),
weekday_visits AS (
    SELECT t.topic, c.date, CAST(coalesce(d.n, 0) AS DOUBLE) AS visit
    FROM (SELECT DISTINCT topic FROM item_days JOIN calendar USING (date) WHERE topic IS NOT NULL) t
    CROSS JOIN calendar c LEFT JOIN item_days d ON d.topic = t.topic AND d.date = c.date)
"""
    return _with(
        _CLEAN,
        visits,
        _PAIRS,
        _scores(),
        select=f"""
    SELECT series, topic1, topic2, cos_{measure} AS similarity FROM scores
    WHERE cos_{measure} IS NOT NULL
    ORDER BY similarity DESC, series, topic1, topic2 LIMIT 20""",
    )


def _report() -> str:
    parts = [_CLEAN, _VISITS, _WEEKDAY_VISITS, _PAIRS, _scores()]
    best = " UNION ALL ".join(
        f"""
    SELECT '{m}' AS measure,
           CAST(row_number() OVER (ORDER BY cos_{m} DESC, series, topic1, topic2) AS INTEGER)
               AS position,
           series, topic1, topic2, cos_{m} AS similarity
    FROM scores WHERE cos_{m} IS NOT NULL"""
        for m in ("mean", "min", "max")
    )
    return _with(*parts, select=f" SELECT * FROM ({best}) AS ranked WHERE position <= 20")


_JUDGED = f"""
landed AS (
    SELECT ts, sid, item, CAST(date_trunc('day', ts) AS TIMESTAMP) + to_days(1) AS pane_end,
           (date_diff('day', (SELECT CAST(min(ts) AS DATE) FROM events), CAST(ts AS DATE))
            + CASE WHEN item >= {LATE_ITEM} THEN {LATE_DAYS} ELSE 0 END) // {PART_DAYS} AS part
    FROM feed),
part_ends AS (SELECT part, max(ts) AS last_ts FROM landed GROUP BY 1),
marks AS (
    SELECT p.part, max(q.last_ts) - INTERVAL 1 HOUR AS watermark
    FROM part_ends p LEFT JOIN part_ends q ON q.part < p.part GROUP BY 1),
judged AS (
    SELECT l.part, l.ts, l.sid, l.item, l.pane_end, m.watermark,
           coalesce(l.pane_end <= m.watermark, false) AS late
    FROM landed l JOIN marks m ON m.part = l.part)"""
_SCORES = " SELECT series, topic1, topic2, cos_mean, cos_min, cos_max FROM scores"
_CLOSED_PAIRS = f"""
    SELECT {_STAMP.format('window_end', 'window_end')}, sid1, sid2, similarity
    FROM window_similar"""

ORACLES: dict[str, str] = {
    "csv_scan_series": _with(_PRICES, select=f" SELECT series, {_DATE}, value FROM prices"),
    "csv_scan_visits": _with(
        _VISITS, select=f" SELECT topic, {_DATE}, CAST(visit AS BIGINT) AS visit FROM visits"
    ),
    "csv_scan_visits_untyped": _with(_VISITS, select=f" SELECT topic, {_DATE}, visit FROM visits"),
    "feed_lines": _with(_FEED, select=" SELECT sid, item, count(*) AS n FROM feed GROUP BY 1, 2"),
    "calendar": _with(
        _PRICES,
        select="""
    SELECT CAST(c.date AS VARCHAR) AS date, count(p.event_id) AS events
    FROM calendar c LEFT JOIN prices p ON p.date = c.date GROUP BY 1""",
    ),
    "calendar_grid": _with(_PRICES, select=f" SELECT series, {_DATE} FROM grid"),
    "missing_slots": _with(
        _PRICES,
        select=f"""
    SELECT series, {_DATE} FROM
        (SELECT series, date FROM grid EXCEPT SELECT series, date FROM one_row) AS missing""",
    ),
    "align_to_calendar": _with(
        _PRICES,
        _VISITS,
        _WEEKDAY_VISITS,
        select=f"""
    SELECT topic, {_DATE}, CAST(date_diff('day', (SELECT CAST(min(ts) AS DATE) FROM events), date) AS INTEGER) AS day_index,
           visit
    FROM weekday_visits""",
    ),
    "weekday_range_filter": _with(
        _PRICES, select=f" SELECT event_id, series, {_DATE}, value FROM in_range"
    ),
    "dedup_series": f"""
    SELECT series, {_DATE}, value FROM (
        SELECT CAST(user_id AS VARCHAR) || '.U' AS series, CAST(ts AS DATE) AS date, value,
               row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS rn
        FROM events) AS ranked
    WHERE rn = 1""",
    "fill_prev_weekday": _with(
        _PRICES,
        _filled("filled_grid", 1),
        select=f" SELECT series, {_DATE}, value, filled FROM filled_grid",
    ),
    "fill_gap_2": _with(
        _PRICES,
        _filled("filled_grid", 2),
        select=f" SELECT series, {_DATE}, value, filled FROM filled_grid",
    ),
    "incomplete_series": _with(
        _PRICES,
        _filled("filled_grid", 1),
        select=" SELECT DISTINCT series FROM filled_grid WHERE value IS NULL",
    ),
    "complete_series": _with(_CLEAN, select=f" SELECT series, {_DATE}, value FROM clean"),
    "clean_series": _with(_CLEAN, select=f" SELECT series, {_DATE}, value FROM clean"),
    "clean_series_relational": _with(_CLEAN, select=f" SELECT series, {_DATE}, value FROM clean"),
    "limit_series": _with(_CLEAN, _FIRST, select=f" SELECT series, {_DATE}, value FROM chosen"),
    "describe_series": _with(
        _PRICES,
        select=f"""
    SELECT count(*) AS row_count, count(DISTINCT series) AS series_count,
           min(series) AS series_min, max(series) AS series_max,
           CAST(min(date) AS VARCHAR) AS date_min, CAST(max(date) AS VARCHAR) AS date_max,
           count(value) AS value_count, round(avg(value), {DIGITS}) AS value_mean,
           round(stddev_samp(value), {DIGITS}) AS value_stddev,
           min(value) AS value_min, max(value) AS value_max
    FROM prices""",
    ),
    "dictionary_encode": _with(
        _PRICES,
        select="""
    SELECT p.event_id, d.series_id
    FROM prices p JOIN (
        SELECT series, row_number() OVER (ORDER BY series) - 1 AS series_id
        FROM (SELECT DISTINCT series FROM prices) AS names) d ON d.series = p.series""",
    ),
    "dictionary_encode_large": _with(
        _PRICES,
        select="""
    SELECT p.event_id, d.series_id, p.series
    FROM prices p JOIN (
        SELECT series, row_number() OVER (ORDER BY series) - 1 AS series_id
        FROM (SELECT DISTINCT series FROM prices) AS names) d ON d.series = p.series""",
    ),
    "dictionary_grow": _with(
        _PRICES,
        select="""
    SELECT p.event_id, d.series_id, p.series
    FROM prices p JOIN (
        SELECT series, row_number() OVER (ORDER BY min(date) > (SELECT min(date) FROM prices), series) - 1 AS series_id
        FROM prices GROUP BY series) d ON d.series = p.series""",
    ),
    "dictionary_decode": _with(_PRICES, select=" SELECT event_id, series FROM prices"),
    "topic_pairs": """
    SELECT a.topic AS topic1, b.topic AS topic2
    FROM (SELECT DISTINCT event_type AS topic FROM events) a
    JOIN (SELECT DISTINCT event_type AS topic FROM events) b ON a.topic < b.topic""",
    "topic_pair_series": _with(
        _PRICES,
        _VISITS,
        _WEEKDAY_VISITS,
        _PAIRS,
        select=f" SELECT topic1, topic2, {_DATE}, mean, min, max FROM pairs",
    ),
    "topic_pairs_supported": _with(
        _PART_DAYS,
        select=f"""
    SELECT a.topic AS topic1, b.topic AS topic2, CAST(count(*) AS INTEGER) AS days
    FROM part_days a JOIN part_days b ON a.date = b.date AND a.topic < b.topic
    GROUP BY 1, 2 HAVING count(*) >= {SHARED_DAYS}""",
    ),
    "topic_pair_series_supported": _with(
        _PART_DAYS,
        select=f"""
    SELECT topic1, topic2, {_DATE}, (x + y) / 2 AS mean, least(x, y) AS min, greatest(x, y) AS max
    FROM (SELECT a.topic AS topic1, b.topic AS topic2, a.date, a.visit AS x, b.visit AS y
          FROM part_days a JOIN part_days b ON a.date = b.date AND a.topic < b.topic) AS met
    QUALIFY count(*) OVER (PARTITION BY topic1, topic2) >= {SHARED_DAYS}""",
    ),
    "series_vectors": _with(
        _PRICES,
        select="""
    SELECT g.series, CAST(n.k - 1 AS INTEGER) AS slot, o.value
    FROM grid g
    JOIN (SELECT date, row_number() OVER (ORDER BY date) AS k FROM calendar) n ON n.date = g.date
    LEFT JOIN one_row o ON o.series = g.series AND o.date = g.date""",
    ),
    "cosine_aligned": _with(_COSINE, select=_SCORES),
    "cosine_aligned_broadcast": _with(_COSINE, select=_SCORES),
    "cosine_vectors": _with(_COSINE, select=_SCORES),
    "cosine_shared_days": _with(_SALES, _PAIRS, _scores(), select=_SCORES),
    "cosine_shared_days_broadcast": _with(_SALES, _PAIRS, _scores(), select=_SCORES),
    "top20_mean": _top("mean"),
    "top20_min": _top("min"),
    "top20_max": _top("max"),
    "top20_items_mean": _top_items("mean"),
    "top20_items_min": _top_items("min"),
    "top20_items_max": _top_items("max"),
    "match_report": _report(),
    "sketch_cells": _with(_SKETCH, select=" SELECT sid, f, v, n FROM cells"),
    "sketch_inner_products": _with(
        _SKETCH, _PRODUCTS, select=" SELECT sid1, sid2, f, product FROM products"
    ),
    "sketch_similarity": _with(
        _SKETCH, _PRODUCTS, select=" SELECT sid1, sid2, similarity FROM alike"
    ),
    "sketch_similarity_threshold": _with(
        _SKETCH,
        _PRODUCTS,
        select=f" SELECT sid1, sid2, similarity FROM alike WHERE similarity > {FEED_THRESHOLD}",
    ),
    "sketch_similarity_sparse": _with(
        _HASHES,
        _PURCHASES,
        _cells(_bucket(WIDE.buckets)),
        _PRODUCTS,
        select=f" SELECT sid1, sid2, similarity FROM alike WHERE similarity > {WIDE_THRESHOLD}",
    ),
    "sketch_similarity_murmur3": _with(
        _FEED,
        _murmur3_cells(),
        _PRODUCTS,
        select=f" SELECT sid1, sid2, similarity FROM alike WHERE similarity > {FEED_THRESHOLD}",
    ),
    "sketch_similarity_windows": _with(_HASHES, _FEED, _WINDOWS, select=_CLOSED_PAIRS),
    "sketch_similarity_long_windows": _with(
        _HASHES,
        _FEED,
        f"""
window_cells AS (
    SELECT make_timestamp((CAST(floor(epoch(e.ts) / 28800) AS BIGINT) + w.ahead) * 28800000000) AS window_end,
           e.sid, h.f, {_bucket(DEFAULT_HASHES.buckets)} AS v, count(*) AS n
    FROM feed e CROSS JOIN hashes h CROSS JOIN generate_series(1, 30) AS w(ahead)
    GROUP BY 1, 2, 3, 4),
products AS (
    SELECT x.window_end, x.sid AS sid1, y.sid AS sid2, x.f AS f,
           CAST(sum(x.n * y.n) AS BIGINT) AS product
    FROM window_cells x JOIN window_cells y
      ON x.window_end = y.window_end AND x.f = y.f AND x.v = y.v AND x.sid > y.sid
    GROUP BY 1, 2, 3, 4),
window_similar AS (
    SELECT window_end, sid1, sid2, min(product) AS similarity FROM products
    GROUP BY 1, 2, 3 HAVING count(*) = 5 AND min(product) > {LONG_THRESHOLD})""",
        select=_CLOSED_PAIRS,
    ),
    "stream_cells": _with(
        _HASHES,
        _FEED,
        f"""
pane_cells AS (
    SELECT CAST(date_trunc('day', e.ts) AS TIMESTAMP) + to_days(1) AS pane_end, e.sid,
           CAST(h.f AS INTEGER) AS f, {_BUCKET} AS v, count(*) AS n
    FROM feed e CROSS JOIN hashes h GROUP BY 1, 2, 3, 4)""",
        select=f"""
    SELECT {_STAMP.format('pane_end', 'pane_end')}, sid, f, v, n FROM pane_cells
    WHERE pane_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    ),
    "stream_similarity": _with(
        _HASHES,
        _FEED,
        _WINDOWS,
        select=_CLOSED_PAIRS + " WHERE window_end <= (SELECT closed FROM watermark)",
    ),
    "stream_progress": _with(
        _HASHES,
        _FEED,
        _WINDOWS,
        select=f"""
    SELECT {_STAMP.format('w.window_end', 'window_end')}, w.events,
           coalesce(p.pairs, 0) AS pairs,
           CAST(sum(w.fresh) OVER (ORDER BY w.window_end) AS BIGINT) AS rows_so_far
    FROM (SELECT window_end, CAST(sum(n) AS BIGINT) AS events, sum(fresh) AS fresh
          FROM window_cells WHERE f = 0 GROUP BY 1) w
    LEFT JOIN (SELECT window_end, count(*) AS pairs FROM window_similar GROUP BY 1) p
      ON p.window_end = w.window_end
    WHERE w.window_end <= (SELECT closed FROM watermark)""",
    ),
    "stream_late_data": _with(
        _FEED,
        _JUDGED,
        select=f"""
    SELECT {_STAMP.format('pane_end', 'pane_end')},
           count(*) FILTER (WHERE NOT late) AS events, count(*) FILTER (WHERE late) AS late
    FROM judged
    WHERE pane_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM feed)
    GROUP BY judged.pane_end HAVING count(*) FILTER (WHERE NOT late) > 0""",
    ),
    "stream_late_rows": _with(
        _FEED,
        _JUDGED,
        select=f"""
    SELECT {_STAMP.format('pane_end', 'pane_end')}, epoch_us(ts) AS ts_micros, sid, item
    FROM judged WHERE late""",
    ),
    "stream_batch_record": _with(
        _FEED,
        _JUDGED,
        select="""
    SELECT batch, rows, late, CAST(sum(rows) OVER (ORDER BY batch) AS BIGINT) AS rows_so_far,
           last_micros, watermark_micros
    FROM (SELECT row_number() OVER (ORDER BY part) - 1 AS batch, count(*) AS rows,
                 count(*) FILTER (WHERE late) AS late, epoch_us(max(ts)) AS last_micros,
                 epoch_us(max(watermark)) AS watermark_micros
          FROM judged GROUP BY part) AS parts""",
    ),
}
ORACLES["stream_text_cells"] = ORACLES["stream_cells"]
ORACLES["stream_cells_timed"] = ORACLES["stream_cells"]
ORACLES["stream_similarity_parts"] = ORACLES["stream_similarity"]
