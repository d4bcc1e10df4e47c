"""Date and time helpers as column expressions.

Formatting and parsing use the session time zone (``build_session`` sets UTC).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
DATE_PATTERN = "yyyy-MM-dd"
DATE_KEY_PATTERN = "yyyyMMdd"
MINUTE_KEY_PATTERN = "yyyyMMddHHmm"
# The log may write the hour without its leading zero.
_PARSE_PATTERN = "yyyy-MM-dd H:mm:ss"


def parse_time(text: Column) -> Column:
    """Text to timestamp; NULL when it is not a valid ``yyyy-MM-dd H:mm:ss``."""
    return F.try_to_timestamp(text, F.lit(_PARSE_PATTERN))


def parse_log_time(text: Column) -> Column:
    """``parse_time`` for the scan of a large log.

    A guarded cast costs a third of a pattern parse; the guard keeps out text that a cast
    would complete with today's date.
    """
    return F.when(text.like("____-__-__ %"), text.try_cast("timestamp"))


def before(left: Column, right: Column) -> Column:
    return parse_time(left) < parse_time(right)


def after(left: Column, right: Column) -> Column:
    return parse_time(left) > parse_time(right)


def minus_seconds(left: Column, right: Column) -> Column:
    """Whole seconds from ``right`` to ``left``, both given as text."""
    return F.timestamp_diff("SECOND", parse_time(right), parse_time(left))


def date_hour(text: Column) -> Column:
    """``yyyy-MM-dd_HH`` of a time given as text."""
    return F.date_format(parse_time(text), "yyyy-MM-dd_HH")


def today() -> Column:
    return F.date_format(F.current_date(), DATE_PATTERN)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_PATTERN)


def format_date(ts: Column) -> Column:
    return F.date_format(ts, DATE_PATTERN)


def format_time(ts: Column) -> Column:
    return F.date_format(ts, TIME_PATTERN)


def format_date_key(ts: Column) -> Column:
    return F.date_format(ts, DATE_KEY_PATTERN)


def parse_date_key(key: Column) -> Column:
    """``yyyyMMdd`` text to a date; NULL when it is none."""
    return F.try_to_timestamp(key, F.lit(DATE_KEY_PATTERN)).cast("date")


def format_minute_key(ts: Column) -> Column:
    return F.date_format(ts, MINUTE_KEY_PATTERN)


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)
