"""The whole job: from raw prices and visits to the best matches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidepair.functions.calendar import DEFAULT_CALENDAR, WeekdayCalendar
from tidepair.operators.align import align_to_calendar
from tidepair.operators.clean import clean_series
from tidepair.operators.cosine import MEASURES, top_matches
from tidepair.operators.select import limit_series
from tidepair.operators.topk import best_per_measure
from tidepair.session import materialize


def prepare_series(
    prices: DataFrame,
    calendar: WeekdayCalendar = DEFAULT_CALENDAR,
    max_series: int | None = None,
    max_gap: int = 1,
    tie: str | None = None,
) -> DataFrame:
    """Cleaned series, all of them or the first ``max_series`` by name number.

    With a limit the cleaned panel is written once, since choosing the names
    and taking their rows would otherwise both clean from the start.
    """
    cleaned = clean_series(prices, calendar, max_gap, tie)
    if max_series is None:
        return cleaned
    return limit_series(materialize(cleaned, "cleaned"), max_series)


def match_series(
    prices: DataFrame,
    visits: DataFrame,
    calendar: WeekdayCalendar = DEFAULT_CALENDAR,
    max_series: int | None = None,
    k: int = 20,
    max_gap: int = 1,
    tie: str | None = None,
    digits: int | None = None,
    measures: tuple[str, ...] = MEASURES,
) -> DataFrame:
    """(measure, position, series, topic1, topic2, similarity): for each measure
    the k triples of series and topic pair that are most alike."""
    series = prepare_series(prices, calendar, max_series, max_gap, tie)
    days = align_to_calendar(visits, calendar)
    return best_per_measure(top_matches(series, days, k, measures, digits), k, digits)
