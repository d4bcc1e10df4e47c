"""Filter predicates of a task. An empty parameter passes every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "-1"


def date_in(date: Column, start: str, end: str) -> Column:
    """Inclusive range on date text, which the parquet scan can prune on."""
    return date.between(start, end)


def number_in(value: Column, low: int | None, high: int | None) -> Column:
    """Inclusive range; applies only when both bounds are set."""
    if low is None or high is None:
        return F.lit(True)
    return value.between(low, high)


def listed_in(value: Column, wanted: Sequence[str]) -> Column:
    """Any item of the comma list ``value`` is in ``wanted``."""
    return F.arrays_overlap(F.split(value, ","), F.array(*[F.lit(w) for w in wanted]))


def any_of(value: Column, wanted: Sequence[str]) -> Column:
    """``listed_in``, except that a value of exactly -1 never matches."""
    if not wanted:
        return F.lit(True)
    return listed_in(value, wanted) & (value != MISSING)


def one_of(value: Column, wanted: Sequence[str]) -> Column:
    """A single text is in ``wanted``; exactly -1 never is. Reaches the parquet scan."""
    listed = [w for w in wanted if w != MISSING]
    return F.lit(True) if not wanted else value.isin(*listed)


def equals(value: Column, wanted: str | None) -> Column:
    return F.lit(True) if not wanted else value == wanted
