"""Daily partial aggregates of the action log.

A date's partials are made of that date's log alone and merge with those of other dates. So
a report over some days reads partials instead of the log, and when actions arrive late or
are corrected, only their dates are made again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.datetime import parse_log_time
from clickloom.functions.predicates import MISSING, date_in, listed_in
from clickloom.operators.categories import KINDS, category_events
from clickloom.operators.sessions import session_measures, summary_of
from clickloom.params import TaskParams

SESSION_DAY = (
    "session_id STRING, user_id LONG, start_ts TIMESTAMP, end_ts TIMESTAMP, step_length LONG,"
    " keywords ARRAY<STRING>, categories ARRAY<LONG>, date STRING"
)
CATEGORY_DAY = (
    "session_id STRING, category_id LONG, click_count LONG, order_count LONG, pay_count LONG,"
    " date STRING"
)


def session_partials(actions: DataFrame) -> DataFrame:
    """One row per date and session, with the sets of words and categories."""
    known = actions.filter("session_id IS NOT NULL")
    return known.groupBy("date", "session_id").agg(*session_measures())


def category_partials(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per date, session and category."""
    counts = [F.count_if(F.col("kind") == kind).alias(f"{kind}_count") for kind in KINDS]
    events = category_events(actions, "date")
    return events.groupBy("date", "session_id", "category_id").agg(*counts)


def refresh(raw: DataFrame, folder: str, dates: Sequence[str]) -> None:
    """Make the partials of ``dates`` again from the raw log; other dates stay untouched.

    Each date is a folder, and dynamic partition overwrite replaces those of ``dates`` alone.
    Every one of them gets a row without key as well: a date without any action left is
    then replaced like the others.
    """
    wanted = raw.filter(F.col("date").isin(*dates))
    actions = wanted.withColumns(
        {
            "action_ts": parse_log_time(F.col("action_time")),
            "click_category_id": F.nullif("click_category_id", F.lit(-1)),
        }
    )
    marks = raw.sparkSession.createDataFrame([(date,) for date in dates], "date string")
    for name, partials in (
        ("sessions", session_partials(actions)),
        ("categories", category_partials(actions)),
    ):
        rows = partials.unionByName(marks, allowMissingColumns=True).hint("rebalance", "date")
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("date").parquet(f"{folder}/{name}")


def _stored(spark: SparkSession, path: str, schema: str, params: TaskParams) -> DataFrame:
    return spark.read.schema(schema).parquet(path).filter(
        date_in(F.col("date"), params.start_date, params.end_date)
    )


def stored_sessions(spark: SparkSession, folder: str, params: TaskParams) -> DataFrame:
    """The session partials of the task's days; only their folders are read."""
    rows = _stored(spark, f"{folder}/sessions", SESSION_DAY, params)
    return rows.filter("session_id IS NOT NULL")


def stored_categories(spark: SparkSession, folder: str, params: TaskParams) -> DataFrame:
    rows = _stored(spark, f"{folder}/categories", CATEGORY_DAY, params)
    return rows.filter("category_id IS NOT NULL")


def _united(sets: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(sets)))).alias(sets)


def merged_sessions(partials: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """``session_summary`` of the log that the partials were made of."""
    measures = [
        F.min("user_id").alias("user_id"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("step_length").alias("step_length"),
        _united("keywords"),
        _united("categories"),
    ]
    if params is not None and params.keywords:
        found = F.exists("keywords", lambda word: listed_in(word, params.keywords))
        real = F.exists("keywords", lambda word: word != MISSING)
        measures.append((F.bool_or(found) & F.bool_or(real)).alias("keyword_hit"))
    if params is not None and params.category_ids:
        wanted = F.array(*[F.lit(i) for i in params.category_ids])
        overlap = F.arrays_overlap(F.col("categories").cast("array<string>"), wanted)
        measures.append(F.bool_or(overlap).alias("category_hit"))
    return summary_of(partials.groupBy("session_id").agg(*measures))


def merged_categories(partials: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """``category_session_counts`` of the log that the partials were made of."""
    counts = partials.groupBy("session_id", "category_id").agg(
        *[F.sum(f"{kind}_count").alias(f"{kind}_count") for kind in KINDS]
    )
    return counts if sessions is None else counts.join(sessions.select("session_id"), "session_id")
