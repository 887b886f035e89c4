"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepair.functions.calendar import WeekdayCalendar
from tidepair.functions.hashing import LinearHashes, Murmur3XorHashes
from tidepair.operators.align import align_to_calendar, series_vectors, sum_visits
from tidepair.operators.clean import (
    calendar_grid,
    clean_series,
    clean_series_relational,
    complete_series,
    dedup_series,
    fill_gaps,
    incomplete_series,
    missing_slots,
    on_calendar,
    weekday_range,
)
from tidepair.operators.cosine import (
    cosine_aligned,
    cosine_aligned_broadcast,
    cosine_vectors,
    top_matches,
)
from tidepair.operators.dictionary import (
    BROADCAST_BYTES,
    build_dictionary,
    decode,
    encode,
    grow_dictionary,
)
from tidepair.operators.pairs import pair_series, supported_pair_series, supported_pairs, topic_pairs
from tidepair.operators.select import describe_series
from tidepair.operators.sketch import (
    build_sketches,
    compare_windows,
    inner_products,
    list_pairs,
    pane_cells,
    sketch_cells,
    sketch_similarity,
    window_cells,
)
from tidepair.operators.sparse import sparse_similarity
from tidepair.operators.topk import top_k
from tidepair.plans.fixtures import (
    event_calendar,
    event_feed,
    event_prices,
    event_stream,
    event_visits,
    item_visits,
    part_visits,
    purchase_feed,
    sale_prices,
    sale_visits,
)
from tidepair.plans.match import match_series, prepare_series
from tidepair.session import shared_folder
from tidepair.sources.feed import naive_utc, open_feed, parse_feed
from tidepair.sources.series import (
    read_prices,
    read_visits,
    read_visits_untyped,
    write_prices,
    write_visits,
)
from tidepair.streaming.bounded import run_until_caught_up
from tidepair.streaming.late import pane_end, read_late, read_record, start_routing
from tidepair.streaming.replay import count_late, replay
from tidepair.streaming.similarity import (
    read_cells,
    read_pair_lists,
    read_progress,
    run_for,
    start_cells,
    start_similarity,
)

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries, scaled to the events table: 100 different items,
# about 67 events per stream in 30 days.
TIE = "event_id"
DIGITS = 6
HASHES = LinearHashes(buckets=64)
# Not a power of two: there, xor with a seed only renames the buckets.
MURMUR = Murmur3XorHashes(buckets=61)
FEED_THRESHOLD = 75
# Some forty purchases of each customer, so a wide sketch has few cells in use.
WIDE = LinearHashes(buckets=50021)
WIDE_THRESHOLD = 3
WINDOW_THRESHOLD = 5
SIZE, SLIDE, DELAY = "5 days", "1 day", "1 hour"
LIMIT = 50
TOPICS_PER_BLOCK = 32

REGISTRY: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        REGISTRY[name] = query
        return query

    return add


def _day(column: str = "date") -> Column:
    return F.col(column).cast("string").alias(column)


def _instant(column: str) -> Column:
    return naive_utc(F.col(column)).cast("string").alias(column)


# Products of the given tables fit 64 bits.
BIGINT = "bigint"


def _whole(column: str) -> Column:
    return F.col(column).cast(BIGINT).alias(column)


def _window_pairs(lists: DataFrame) -> DataFrame:
    """The instant of a window is put in words once for each list, not for each pair."""
    return list_pairs(lists.withColumn("window_end", _instant("window_end")), BIGINT, "window_end")


def _rounded(scores: DataFrame) -> DataFrame:
    return scores.select(
        "series",
        "topic1",
        "topic2",
        *(F.round(c, DIGITS).alias(c) for c in ("cos_mean", "cos_min", "cos_max")),
    )


def _deduplicated(spark: SparkSession, sf_dir: str, calendar: WeekdayCalendar) -> DataFrame:
    return on_calendar(event_prices(spark, sf_dir, calendar), calendar, TIE)


def _clean(spark: SparkSession, sf_dir: str, calendar: WeekdayCalendar) -> DataFrame:
    return clean_series(event_prices(spark, sf_dir, calendar), calendar, tie=TIE)


def _visits(spark: SparkSession, sf_dir: str, calendar: WeekdayCalendar) -> DataFrame:
    return align_to_calendar(event_visits(spark, sf_dir, calendar), calendar)


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cleaned series and aligned visits."""
    calendar = event_calendar(spark, sf_dir)
    return _clean(spark, sf_dir, calendar), _visits(spark, sf_dir, calendar)


# -- sources ------------------------------------------------------------------


@register("csv_scan_series")
def csv_scan_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "prices")
    prices = event_prices(spark, sf_dir).withColumn("volume", (F.col("event_id") % 1_000_000).cast("int"))
    write_prices(prices, path)
    return read_prices(spark, path).select("series", _day(), "value")


@register("csv_scan_visits")
def csv_scan_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "visits")
    write_visits(_summed(spark, sf_dir), path)
    return read_visits(spark, path).select("topic", _day(), "visit")


@register("csv_scan_visits_untyped")
def csv_scan_visits_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "visits")
    write_visits(_summed(spark, sf_dir), path)
    return read_visits_untyped(spark, path).select("topic", _day(), "visit")


def _summed(spark: SparkSession, sf_dir: str) -> DataFrame:
    summed = sum_visits(event_visits(spark, sf_dir))
    return summed.withColumn("visit", F.col("visit").cast("bigint"))


@register("feed_lines")
def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text lines and back, with broken lines among them: the props
    text in place of an item does not parse."""
    feed = event_feed(spark, sf_dir)
    good = F.concat_ws(",", "sid", "item")
    broken = F.concat_ws(",", F.lit("x"), "item")
    lines = feed.select("ts", F.explode(F.array(good, broken)).alias("value"))
    return parse_feed(lines, F.col("ts")).groupBy("sid", "item").agg(
        F.count(F.lit(1)).alias("n")
    )


# -- calendar and cleaning ----------------------------------------------------


@register("calendar")
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekdays of the calendar and the number of events on each."""
    days = event_calendar(spark, sf_dir)
    weekdays = days.dates(spark)
    seen = event_prices(spark, sf_dir, days).groupBy("date").agg(
        F.count(F.lit(1)).alias("events")
    )
    return weekdays.join(seen, "date", "left").select(
        _day(), F.coalesce("events", F.lit(0)).alias("events")
    )


@register("calendar_grid")
def calendar_grid_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = event_calendar(spark, sf_dir)
    grid = calendar_grid(_deduplicated(spark, sf_dir, days), days)
    return grid.select("series", _day())


@register("missing_slots")
def missing_slots_of_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = event_calendar(spark, sf_dir)
    missing = missing_slots(_deduplicated(spark, sf_dir, days), days)
    return missing.select("series", _day())


@register("align_to_calendar")
def align_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = event_calendar(spark, sf_dir)
    aligned = align_to_calendar(sum_visits(event_visits(spark, sf_dir)), days)
    return aligned.select("topic", _day(), "day_index", "visit")


@register("weekday_range_filter")
def weekday_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = event_calendar(spark, sf_dir)
    rows = weekday_range(event_prices(spark, sf_dir, days), days)
    return rows.select("event_id", "series", _day(), "value")


@register("dedup_series")
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_series(event_prices(spark, sf_dir), TIE)
    return rows.select("series", _day(), "value")


def _grid(spark: SparkSession, sf_dir: str, max_gap: int) -> DataFrame:
    days = event_calendar(spark, sf_dir)
    return fill_gaps(_deduplicated(spark, sf_dir, days), days, max_gap)


@register("fill_prev_weekday")
def fill_prev_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir, 1).select("series", _day(), "value", "filled")


@register("fill_gap_2")
def fill_gap_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir, 2).select("series", _day(), "value", "filled")


@register("incomplete_series")
def incomplete_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incomplete_series(_grid(spark, sf_dir, 1))


@register("complete_series")
def complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_series(_grid(spark, sf_dir, 1)).select("series", _day(), "value")


@register("clean_series")
def clean_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = event_calendar(spark, sf_dir)
    return _clean(spark, sf_dir, days).select("series", _day(), "value")


@register("clean_series_relational")
def clean_panel_relational(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = event_calendar(spark, sf_dir)
    prices = event_prices(spark, sf_dir, days)
    cleaned = clean_series_relational(prices, days, tie=TIE)
    return cleaned.select("series", _day(), "value")


@register("limit_series")
def limit_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = event_calendar(spark, sf_dir)
    prices = event_prices(spark, sf_dir, days)
    chosen = prepare_series(prices, days, LIMIT, tie=TIE)
    return chosen.select("series", _day(), "value")


@register("describe_series")
def describe_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = describe_series(event_prices(spark, sf_dir))
    return row.select(
        "row_count",
        "series_count",
        "series_min",
        "series_max",
        _day("date_min"),
        _day("date_max"),
        "value_count",
        F.round("value_mean", DIGITS).alias("value_mean"),
        F.round("value_stddev", DIGITS).alias("value_stddev"),
        "value_min",
        "value_max",
    )


# -- dictionary, pairs, vectors -----------------------------------------------


@register("dictionary_encode")
def dictionary_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = event_prices(spark, sf_dir)
    names = build_dictionary(prices, "series")
    return encode(prices, names, "series", "series_id").select("event_id", "series_id")


@register("dictionary_encode_large")
def dictionary_encode_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``dictionary_encode`` with the join for dictionaries that are not broadcast."""
    prices = event_prices(spark, sf_dir)
    names = replace(build_dictionary(prices, "series"), bytes=BROADCAST_BYTES + 1)
    coded = encode(prices, names, "series", "series_id")
    return decode(coded, names, "series_id", "series").join(
        coded.select("event_id", "series_id"), "event_id"
    ).select("event_id", "series_id", "series")


@register("dictionary_decode")
def dictionary_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = event_prices(spark, sf_dir)
    names = build_dictionary(prices, "series")
    encoded = encode(prices, names, "series", "series_id")
    return decode(encoded, names, "series_id", "series").select("event_id", "series")


@register("dictionary_grow")
def dictionary_grow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of the first day are numbered first, new ones of the other days after
    them; all rows are encoded with the version of their day and decoded with the last."""
    prices, path = event_prices(spark, sf_dir), shared_folder(spark, "names")
    first = F.col("date") <= F.lit(event_calendar(spark, sf_dir).start)
    coded = []
    for part in (prices.where(first), prices.where(~first)):
        book = grow_dictionary(part, "series", path)
        coded.append(encode(part.select("event_id", "series"), book, "series", "series_id"))
    every = coded[0].unionByName(coded[1])
    return decode(every.withColumn("id", F.col("series_id")), book, "id", "series").select(
        "event_id", "series_id", "series"
    )


@register("topic_pairs")
def topic_pair_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_pairs(event_visits(spark, sf_dir))


@register("topic_pair_series")
def topic_pair_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = event_calendar(spark, sf_dir)
    pairs = pair_series(_visits(spark, sf_dir, days))
    return pairs.select("topic1", "topic2", _day(), "mean", "min", "max")


# Parts that are shipped on so many days alike.
SHARED_DAYS = 3


@register("topic_pairs_supported")
def topic_pairs_supported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Among all parts, those that are shipped on the same days."""
    return supported_pairs(part_visits(spark, sf_dir), SHARED_DAYS)


@register("topic_pair_series_supported")
def topic_pair_series_supported(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = supported_pair_series(part_visits(spark, sf_dir), SHARED_DAYS)
    return pairs.select("topic1", "topic2", _day(), "mean", "min", "max")


@register("series_vectors")
def vectors_of_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = event_calendar(spark, sf_dir)
    vectors = series_vectors(_deduplicated(spark, sf_dir, days), days)
    return vectors.select(
        F.col("name").alias("series"), F.posexplode("vector").alias("slot", "value")
    )


# -- cosine -------------------------------------------------------------------


@register("cosine_aligned")
def cosine_by_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cosine_aligned(*_inputs(spark, sf_dir)))


@register("cosine_aligned_broadcast")
def cosine_by_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cosine_aligned_broadcast(*_inputs(spark, sf_dir)))


@register("cosine_vectors")
def cosine_by_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = event_calendar(spark, sf_dir)
    visits = event_visits(spark, sf_dir, days)
    return _rounded(cosine_vectors(_clean(spark, sf_dir, days), visits, days))


@register("cosine_shared_days")
def cosine_shared_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series with holes: sums and norms over the days that all three have."""
    return _rounded(cosine_aligned(sale_prices(spark, sf_dir), sale_visits(spark, sf_dir)))


@register("cosine_shared_days_broadcast")
def cosine_shared_days_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        cosine_aligned_broadcast(sale_prices(spark, sf_dir), sale_visits(spark, sf_dir))
    )


def _top(spark: SparkSession, sf_dir: str, measure: str) -> DataFrame:
    matches = top_matches(*_inputs(spark, sf_dir), 20, (measure,), DIGITS)
    return top_k(matches, measure, 20, DIGITS)


@register("top20_mean")
def top20_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, "mean")


@register("top20_min")
def top20_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, "min")


@register("top20_max")
def top20_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, "max")


def _many_topics(spark: SparkSession, sf_dir: str, measure: str) -> DataFrame:
    """Of all pairs of items, in several blocks of topics."""
    days = event_calendar(spark, sf_dir)
    visits = item_visits(spark, sf_dir, days)
    matches = top_matches(_clean(spark, sf_dir, days), visits, 20, (measure,), DIGITS, TOPICS_PER_BLOCK)
    return top_k(matches, measure, 20, DIGITS)


@register("top20_items_mean")
def top20_items_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _many_topics(spark, sf_dir, "mean")


@register("top20_items_min")
def top20_items_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _many_topics(spark, sf_dir, "min")


@register("top20_items_max")
def top20_items_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _many_topics(spark, sf_dir, "max")


@register("match_report")
def match_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw rows to the best 20 of each measure, among all series."""
    days = event_calendar(spark, sf_dir)
    return match_series(
        event_prices(spark, sf_dir, days),
        event_visits(spark, sf_dir, days),
        days,
        tie=TIE,
        digits=DIGITS,
    )


# -- sketch -------------------------------------------------------------------


@register("sketch_cells")
def sketch_feed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_cells(event_feed(spark, sf_dir), HASHES)


@register("sketch_inner_products")
def sketch_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_products(sketch_cells(event_feed(spark, sf_dir), HASHES), HASHES, kind=BIGINT)


@register("sketch_similarity")
def sketch_similar_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_similarity(sketch_cells(event_feed(spark, sf_dir), HASHES), HASHES, kind=BIGINT)


@register("sketch_similarity_threshold")
def sketch_similarity_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = sketch_cells(event_feed(spark, sf_dir), HASHES)
    return sketch_similarity(cells, HASHES, FEED_THRESHOLD, kind=BIGINT)


@register("sketch_similarity_sparse")
def sketch_similarity_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that buy the same parts, from the cells that they share."""
    cells = sketch_cells(purchase_feed(spark, sf_dir), WIDE)
    return sparse_similarity(cells, WIDE, WIDE_THRESHOLD).withColumn("similarity", _whole("similarity"))


@register("sketch_similarity_murmur3")
def sketch_similarity_murmur3(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = sketch_cells(event_feed(spark, sf_dir), MURMUR)
    return sketch_similarity(cells, MURMUR, FEED_THRESHOLD, kind=BIGINT)


@register("sketch_similarity_windows")
def sketch_similarity_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = window_cells(pane_cells(event_feed(spark, sf_dir), HASHES, SLIDE), SIZE, SLIDE)
    return _window_pairs(compare_windows(build_sketches(cells, HASHES), HASHES, WINDOW_THRESHOLD))


# The widths of the defaults: 3,000 buckets and windows of thirty panes.
LONG_SIZE, LONG_SLIDE, LONG_THRESHOLD = "10 days", "8 hours", 12
DEFAULT_HASHES = LinearHashes()


@register("sketch_similarity_long_windows")
def sketch_similarity_long_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    panes = pane_cells(event_feed(spark, sf_dir), DEFAULT_HASHES, LONG_SLIDE)
    cells = window_cells(panes, LONG_SIZE, LONG_SLIDE)
    sketches = build_sketches(cells, DEFAULT_HASHES)
    return _window_pairs(compare_windows(sketches, DEFAULT_HASHES, LONG_THRESHOLD))


# -- streaming ----------------------------------------------------------------


@register("stream_cells")
def stream_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_folder(spark, "stream")
    run_for(start_cells(event_stream(spark, sf_dir), HASHES, out, SLIDE, DELAY, once=True))
    return read_cells(spark, out).select(_instant("pane_end"), "sid", "f", "v", "n")


# A live run is ended after so many seconds whether it has caught up or not.
DEADLINE = 300.0


@register("stream_cells_timed")
def stream_cells_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_cells``, from a run on the timed trigger that ends when what has
    landed is committed."""
    out = shared_folder(spark, "stream")
    stream = event_stream(spark, sf_dir)
    _, caught = run_until_caught_up(
        spark, lambda: start_cells(stream, HASHES, out, SLIDE, DELAY, every="1 second"), DEADLINE
    )
    if not caught:
        raise TimeoutError(f"the feed was not read within {DEADLINE} seconds")
    return read_cells(spark, out).select(_instant("pane_end"), "sid", "f", "v", "n")


def _run_similarity(spark: SparkSession, sf_dir: str) -> str:
    out = shared_folder(spark, "stream")
    stream = event_stream(spark, sf_dir)
    run_for(
        start_similarity(
            stream, HASHES, out, SIZE, SLIDE, DELAY, WINDOW_THRESHOLD, once=True
        )
    )
    return out


@register("stream_similarity")
def stream_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_pairs(read_pair_lists(spark, _run_similarity(spark, sf_dir)))


@register("stream_progress")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    progress = read_progress(spark, _run_similarity(spark, sf_dir))
    return progress.select(_instant("window_end"), "events", "pairs", "rows_so_far")


def _days(spark: SparkSession, sf_dir: str) -> Column:
    start = event_calendar(spark, sf_dir).start
    return F.date_diff(naive_utc(F.col("ts")).cast("date"), F.lit(start))


@register("stream_similarity_parts")
def stream_similarity_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_similarity``, from a feed that lands in parts: state is carried
    over micro-batches and restarts."""

    def start(stream: DataFrame, out: str) -> StreamingQuery:
        return start_similarity(stream, HASHES, out, SIZE, SLIDE, DELAY, WINDOW_THRESHOLD, once=True)

    feed = event_feed(spark, sf_dir)
    part = F.floor(_days(spark, sf_dir) / PART_DAYS)
    _, out = replay(feed, part, start)
    return _window_pairs(read_pair_lists(spark, out))


@register("stream_text_cells")
def stream_text_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_cells``, from a text feed with a broken line for every good one."""
    lines, out = shared_folder(spark, "lines"), shared_folder(spark, "stream")
    good = F.concat_ws(",", "sid", "item", F.unix_micros("ts"))
    broken = F.concat_ws(",", "sid", F.lit("x"), F.unix_micros("ts"))
    feed = event_feed(spark, sf_dir).where("sid IS NOT NULL AND item IS NOT NULL")
    feed.select(F.explode(F.array(good, broken)).alias("value")).write.text(lines)
    micros = F.get(F.split("value", ","), F.lit(2)).try_cast("bigint")
    stream = parse_feed(open_feed(spark, "text", path=lines), F.timestamp_micros(micros))
    run_for(start_cells(stream, HASHES, out, SLIDE, DELAY, once=True))
    return read_cells(spark, out).select(_instant("pane_end"), "sid", "f", "v", "n")


# Events with a high item arrive three days late, all others at once; the feed
# lands in parts of ten days.
LATE_ITEM, LATE_DAYS, PART_DAYS = 90, 3, 10


def _late_part(spark: SparkSession, sf_dir: str) -> Column:
    days = _days(spark, sf_dir) + F.when(F.col("item") >= LATE_ITEM, LATE_DAYS).otherwise(0)
    return F.floor(days / PART_DAYS).cast("int")


@register("stream_late_data")
def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = event_feed(spark, sf_dir)
    return count_late(feed, _late_part(spark, sf_dir), SLIDE, DELAY).select(
        _instant("pane_end"), "events", "late"
    )


def _route_late(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    def start(stream: DataFrame, out: str) -> StreamingQuery:
        return start_routing(stream, out, SLIDE, DELAY, once=True)

    feed = event_feed(spark, sf_dir)
    return feed, replay(feed, _late_part(spark, sf_dir), start)[1]


@register("stream_late_rows")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late rows themselves, from a side output over several batches and restarts."""
    feed, out = _route_late(spark, sf_dir)
    return (
        read_late(spark, out, feed.schema)
        .withColumn("pane_end", pane_end(SLIDE))
        .select(_instant("pane_end"), F.unix_micros("ts").alias("ts_micros"), "sid", "item")
    )


@register("stream_batch_record")
def stream_batch_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, late rows and watermark of each batch, as observed while it was written."""
    _, out = _route_late(spark, sf_dir)
    return read_record(spark, out).select(
        "batch",
        "rows",
        "late",
        "rows_so_far",
        F.unix_micros("last").alias("last_micros"),
        F.unix_micros("watermark").alias("watermark_micros"),
    )
