"""Session rollup, session filters, length histograms and session detail."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.datetime import format_time
from clickloom.functions.predicates import MISSING, equals, listed_in, number_in, one_of
from clickloom.functions.text import round_half_up
from clickloom.params import TaskParams
from clickloom.session import materialize

# Bucket name, inclusive lower bound, inclusive upper bound.
# A visit of 0 seconds belongs to no bucket.
VISIT_BUCKETS = [
    ("visit_length_1s_3s", 1, 3),
    ("visit_length_4s_6s", 4, 6),
    ("visit_length_7s_9s", 7, 9),
    ("visit_length_10s_30s", 10, 30),
    ("visit_length_30s_60s", 31, 60),
    ("visit_length_1m_3m", 61, 180),
    ("visit_length_3m_10m", 181, 600),
    ("visit_length_10m_30m", 601, 1800),
    ("visit_length_30m", 1801, None),
]
STEP_BUCKETS = [
    ("step_length_1_3", 1, 3),
    ("step_length_4_6", 4, 6),
    ("step_length_7_9", 7, 9),
    ("step_length_10_30", 10, 30),
    ("step_length_30_60", 31, 60),
    ("step_length_60", 61, None),
]


def _any_row(condition: Column) -> Column:
    return F.coalesce(F.bool_or(condition), F.lit(False))


def length_measures() -> list[Column]:
    """The aggregates of a session's actions that are of fixed width."""
    return [
        F.min(F.nullif(F.col("user_id"), F.lit(-1))).alias("user_id"),
        F.min("action_ts").alias("start_ts"),
        F.max("action_ts").alias("end_ts"),
        F.count(F.lit(1)).alias("step_length"),
    ]


def session_measures() -> list[Column]:
    """The aggregates of a session's actions."""
    keyword = F.nullif(F.col("search_keyword"), F.lit(""))
    return [
        *length_measures(),
        F.array_sort(F.collect_set(keyword)).alias("keywords"),
        F.array_sort(F.collect_set("click_category_id")).alias("categories"),
    ]


def session_summary(actions: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """One row per session. An action without a session belongs to none.

    The two sets hold a session's distinct words and categories; they are reduced in the map
    tasks, so repeated ones never travel. The keyword and category filters of ``params``
    become boolean aggregates, so a plan that only filters and counts never builds the sets:
    Catalyst drops them and the aggregate stays a hash aggregate over fixed-width buffers.
    """
    keyword = F.nullif(F.col("search_keyword"), F.lit(""))
    measures = session_measures()
    if params is not None and params.keywords:
        # Exactly "-1" as a session's only word never matches.
        hit = _any_row(listed_in(keyword, params.keywords)) & _any_row(keyword != MISSING)
        measures.append(hit.alias("keyword_hit"))
    if params is not None and params.category_ids:
        wanted = F.col("click_category_id").cast("string").isin(*params.category_ids)
        measures.append(_any_row(wanted).alias("category_hit"))
    known = actions.filter("session_id IS NOT NULL")
    return summary_of(known.groupBy("session_id").agg(*measures))


def summary_of(grouped: DataFrame) -> DataFrame:
    """``session_summary`` from the measures of each session."""
    flags = [c for c in ("keyword_hit", "category_hit") if c in grouped.columns]
    return grouped.select(
        "session_id",
        "user_id",
        "start_ts",
        F.timestamp_diff("SECOND", F.col("start_ts"), F.col("end_ts")).alias("visit_length"),
        "step_length",
        F.nullif(F.array_join("keywords", ","), F.lit("")).alias("search_keywords"),
        F.nullif(F.array_join(F.col("categories").cast("array<string>"), ","), F.lit("")).alias(
            "click_category_ids"
        ),
        *flags,
    )


def filtered_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions of known users that pass every filter of the task."""
    return known_sessions(session_summary(actions, params), users, params)


def known_sessions(summary: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """``filtered_sessions`` from the sessions' summary for the same task.

    The user filters are pushed to the user scan. The join is left to Catalyst, which
    broadcasts the users only by their size; AQE splits the partition of a hot user.
    """
    predicates = [
        number_in(F.col("age"), params.start_age, params.end_age),
        one_of(F.col("professional"), params.professionals),
        one_of(F.col("city"), params.cities),
        equals(F.col("sex"), params.sex),
    ]
    predicates += [F.col(c) for c in ("keyword_hit", "category_hit") if c in summary.columns]
    return (
        summary.join(users.select("user_id", "age", "professional", "city", "sex"), "user_id")
        .filter(reduce(and_, predicates))
        .select(
            "session_id",
            "user_id",
            format_time(F.col("start_ts")).alias("start_time"),
            "visit_length",
            "step_length",
            "search_keywords",
            "click_category_ids",
            "age",
            "professional",
            "city",
            "sex",
        )
    )


def session_detail(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Every action of the given sessions.

    The chosen sessions are stored first: both sides of the join are then plain scans, so
    that AQE can split the partition of a session that holds a large part of the log.
    """
    chosen = materialize(sessions.select("session_id"), "chosen-sessions")
    return actions.join(chosen, "session_id", "left_semi")


def _in_bucket(value: Column, low: int, high: int | None) -> Column:
    return value >= low if high is None else value.between(low, high)


def length_histogram(sessions: DataFrame) -> DataFrame:
    """One row: the number of sessions and of those in each length bucket."""
    counts = [
        F.count_if(_in_bucket(F.col(source), low, high)).alias(name)
        for source, buckets in (("visit_length", VISIT_BUCKETS), ("step_length", STEP_BUCKETS))
        for name, low, high in buckets
    ]
    return sessions.agg(F.count(F.lit(1)).alias("session_count"), *counts)


def length_ratios(sessions: DataFrame) -> DataFrame:
    """One row: each bucket's share of the sessions; NULL when there is no session."""
    names = [name for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS]
    total = F.nullif(F.col("session_count"), F.lit(0))
    return length_histogram(sessions).select(
        "session_count",
        *[round_half_up(F.col(name) / total).alias(f"{name}_ratio") for name in names],
    )
