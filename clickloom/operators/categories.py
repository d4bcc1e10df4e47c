"""Clicks, orders and payments per category, hot categories and their busiest sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("click", "order", "pay")


def category_events(actions: DataFrame, *keep: str) -> DataFrame:
    """One row per category an action clicked, ordered or paid for; ``keep`` are more columns."""
    own = ["session_id", *keep]
    sources = {
        "click": F.col("click_category_id").cast("string"),
        "order": F.col("order_category_ids"),
        "pay": F.col("pay_category_ids"),
    }
    by_kind = F.array(
        *[F.struct(F.lit(kind).alias("kind"), ids.alias("ids")) for kind, ids in sources.items()]
    )
    return (
        actions.filter(
            F.col("click_category_id").isNotNull()
            | F.col("order_category_ids").isNotNull()
            | F.col("pay_category_ids").isNotNull()
        )
        .select(*own, F.inline(F.filter(by_kind, lambda kind: kind["ids"].isNotNull())))
        .select(*own, "kind", F.explode(F.split("ids", ",")).alias("id"))
        .select(*own, "kind", F.col("id").try_cast("long").alias("category_id"))
        .filter(F.col("category_id").isNotNull())
    )


def category_session_counts(actions: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Counts per category and session, for the given sessions (all when None).

    The log is combined to (session, category) before any shuffle and only then joined
    with the sessions, so a session with a third of all actions is a few rows by then. The
    sessions are distinct, so an inner join keeps what a semi join would; Catalyst would
    move a semi join below the aggregate and shuffle every action.
    """
    counts = [F.count_if(F.col("kind") == kind).alias(f"{kind}_count") for kind in KINDS]
    grouped = category_events(actions).groupBy("session_id", "category_id").agg(*counts)
    if sessions is None:
        return grouped
    return grouped.join(sessions.select("session_id"), "session_id")


def category_counts(per_session: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category; a kind that never occurs counts 0."""
    return per_session.groupBy("category_id").agg(
        *[F.sum(f"{kind}_count").alias(f"{kind}_count") for kind in KINDS]
    )


def top_categories(counts: DataFrame, limit: int = 10) -> DataFrame:
    """The hottest categories by clicks, then orders, then payments."""
    return counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), "category_id"
    ).limit(limit)


def top_sessions(per_session: DataFrame, top: DataFrame, limit: int = 10) -> DataFrame:
    """For each hot category the sessions that click it most.

    ``top`` comes from ``top_categories`` and is as small as its limit.
    """
    rank = Window.partitionBy("category_id").orderBy(F.desc("click_count"), "session_id")
    return (
        per_session.filter(F.col("click_count") > 0)
        .join(F.broadcast(top.select("category_id")), "category_id")
        .withColumn("place", F.row_number().over(rank))
        .filter(F.col("place") <= limit)
        .select("category_id", "session_id", "click_count")
    )


def top_session_detail(actions: DataFrame, top: DataFrame, repeat: bool = False) -> DataFrame:
    """Actions of the top sessions; ``repeat`` yields them once per category they lead.

    ``top`` comes from ``top_sessions``: at most limit x limit rows.
    """
    keys = F.broadcast(top.select("session_id"))
    return actions.join(keys, "session_id", "inner" if repeat else "left_semi")
