"""Random extract of sessions, spread over days and hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.datetime import format_time
from clickloom.operators.sessions import session_summary

# A drawn set up to this size is broadcast to fetch its actions.
MAX_BROADCAST_SAMPLE = 10_000


def _with_date_hour(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id",
        "start_time",
        F.substring("start_time", 1, 10).alias("date"),
        F.substring("start_time", 12, 2).alias("hour"),
    )


def hourly_session_counts(sessions: DataFrame) -> DataFrame:
    """Sessions by the date and hour they start in."""
    return (
        _with_date_hour(sessions)
        .groupBy("date", "hour")
        .agg(F.count(F.lit(1)).alias("session_count"))
    )


def sample_quota(hourly: DataFrame, sample_size: int = 100) -> DataFrame:
    """How many sessions to draw from each hour; in total ``sample_size``, or all there are.

    The sample is split evenly over the days. A day with fewer sessions than its share
    gives all it has, and the others share the rest; what does not divide goes to the
    earliest of them, one each. A day's quota is split over its hours in proportion to their
    sessions by largest remainder. All numbers are whole. Taken from the smallest day up, a
    day gives all it has as long as it has at most an even share of what the days before
    it left. The windows hold one row per day and at most 24 rows of a day.
    """
    daily = hourly.groupBy("date").agg(F.sum("session_count").alias("day_count"))
    by_size = Window.orderBy("day_count", "date")
    before = by_size.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.lit(sample_size) - F.coalesce(F.sum("day_count").over(before), F.lit(0))
    whole = F.col("day_count") * F.col("days_left") <= F.col("rest")
    all_by_size = by_size.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    unfilled = F.when(~whole, F.struct("rest", "days_left"))
    shared = F.col("first.rest") % F.col("first.days_left")
    per_day = (
        daily.withColumn("rest", rest)
        .withColumn("place", F.row_number().over(by_size))
        .withColumn("days_left", F.count(F.lit(1)).over(all_by_size) - F.col("place") + 1)
        .withColumn("first", F.first(unfilled, ignorenulls=True).over(all_by_size))
        .withColumn("whole", F.col("first").isNull() | (F.col("days_left") > F.col("first.days_left")))
        .withColumn("early", F.row_number().over(Window.partitionBy("whole").orderBy("date")))
        .select(
            "date",
            "day_count",
            F.when(F.col("whole"), F.col("day_count"))
            .otherwise(
                F.expr("first.rest div first.days_left") + (F.col("early") <= shared).cast("long")
            )
            .alias("per_day"),
        )
    )
    day = Window.partitionBy("date")
    by_remainder = day.orderBy(F.desc("remainder"), "hour")
    return (
        hourly.join(per_day, "date")
        .withColumn("product", F.col("session_count") * F.col("per_day"))
        .withColumn("remainder", F.col("product") % F.col("day_count"))
        .withColumn("base", F.expr("product div day_count"))
        .withColumn("spare", F.col("per_day") - F.sum("base").over(day))
        .withColumn("place", F.row_number().over(by_remainder))
        .select(
            "date",
            "hour",
            "session_count",
            (F.col("base") + (F.col("place") <= F.col("spare")).cast("long")).alias("quota"),
        )
    )


def _draw_order(seed: int) -> Column:
    return F.md5(F.concat(F.col("session_id"), F.lit(f"#{seed}")).cast("binary"))


def sample_sessions(sessions: DataFrame, sample_size: int = 100, seed: int = 42) -> DataFrame:
    """Draw each hour's quota without replacement; the same seed draws the same sessions.

    No quota exceeds ``sample_size``, so the rank is first cut at that constant: Spark then
    keeps at most ``sample_size`` rows of an hour in every map task, and a hot hour costs
    no more than any other.
    """
    stamped = _with_date_hour(sessions)
    hour = Window.partitionBy("date", "hour").orderBy(_draw_order(seed), "session_id")
    ranked = stamped.withColumn("place", F.row_number().over(hour)).filter(
        F.col("place") <= sample_size
    )
    quota = sample_quota(hourly_session_counts(sessions), sample_size)
    return (
        ranked.join(quota, ["date", "hour"])
        .filter(F.col("place") <= F.col("quota"))
        .select("date", "hour", "session_id", "start_time")
    )


def keep_actions_of(actions: DataFrame, drawn: DataFrame, size: int) -> DataFrame:
    """Actions of at most ``size`` drawn sessions, without shuffling the log when it is small."""
    keys = drawn.select("session_id")
    if size <= MAX_BROADCAST_SAMPLE:
        keys = F.broadcast(keys)
    return actions.join(keys, "session_id", "left_semi")


def extract_report(actions: DataFrame, drawn: DataFrame, sample_size: int = 100) -> DataFrame:
    """The drawn sessions with their start, search words and clicked categories.

    The sets are built for the drawn sessions only.
    """
    return session_summary(keep_actions_of(actions, drawn, sample_size)).select(
        "session_id",
        format_time(F.col("start_ts")).alias("start_time"),
        "search_keywords",
        "click_category_ids",
    )
