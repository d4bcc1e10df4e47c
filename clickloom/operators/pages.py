"""One-step conversion along a target page flow."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.text import round_half_up
from clickloom.operators.skew import MIN_HEAVY_ROWS, heavy_keys
from clickloom.session import materialize


def page_steps(actions: DataFrame, heavy_rows: int = MIN_HEAVY_ROWS) -> DataFrame:
    """Weighted steps (page_id, next_page_id, steps) between consecutive actions of a session.

    Actions are ordered by time, then page. ``next_page_id`` is NULL after the last action
    of a session, so the steps of a page sum to its views. An action without a session
    belongs to none and leads nowhere. Pages and times may be NULL; a NULL time is before
    all others.

    An ordinary session is one window, and its actions are shuffled once. A session with
    ``heavy_rows`` actions would be one task's work; its actions are scanned in segments.
    """
    every = actions.select("session_id", "action_ts", "page_id")
    last = F.lit(None).cast(actions.schema["page_id"].dataType)
    alone = every.filter("session_id IS NULL").select("page_id", last.alias("next_page_id"))
    log = every.filter("session_id IS NOT NULL")
    heavy = heavy_keys(log, "session_id", heavy_rows)
    if heavy.isEmpty():
        return _each_once(_session_steps(log).unionByName(alone))
    heavy = F.broadcast(materialize(heavy, "heavy-sessions"))
    light = _session_steps(log.join(heavy, "session_id", "left_anti")).unionByName(alone)
    segments = segmented(log.join(heavy, "session_id", "left_semi"))
    return _each_once(light).unionByName(segment_steps(segments))


def _session_steps(log: DataFrame) -> DataFrame:
    by_time = Window.partitionBy("session_id").orderBy("action_ts", "page_id")
    return log.select("page_id", F.lead("page_id").over(by_time).alias("next_page_id"))


def _each_once(steps: DataFrame) -> DataFrame:
    return steps.withColumn("steps", F.lit(1).cast("long"))


def segmented(log: DataFrame) -> DataFrame:
    """``log`` dealt over ranges of (session, time, page), with the range as ``segment``.

    The ranges hold about as many actions each, whatever sessions and seconds they belong
    to: a number of its own for each action lets a range end between equal ones. The rows
    are written once, so that both parts of the scan see the same ranges.
    """
    number = F.xxhash64(F.monotonically_increasing_id())
    ordered = log.withColumn("number", number).repartitionByRange(
        "session_id", "action_ts", "page_id", "number"
    )
    placed = ordered.drop("number").withColumn("segment", F.spark_partition_id())
    return materialize(placed, "page-segments")


def segment_steps(segments: DataFrame) -> DataFrame:
    """The steps of ``segmented`` actions: a scan of segments, each with the last row before it.

    Within a segment a step leads from a row to the next one of the session. The last page
    of a session in one segment leads to the first in the next segment that has the session;
    what is ordered over all of a session is one row for each segment.
    """
    own = Window.partitionBy("session_id", "segment").orderBy("action_ts", "page_id")
    after = F.lead(F.struct("page_id")).over(own)
    # The last row is told by having no row after it, not by a NULL page.
    inside = (
        segments.select("page_id", after.alias("after"))
        .filter("after IS NOT NULL")
        .select("page_id", F.col("after.page_id").alias("next_page_id"))
        .groupBy("page_id", "next_page_id")
        .agg(F.count(F.lit(1)).alias("steps"))
    )
    order = F.struct("action_ts", "page_id")
    edges = segments.groupBy("session_id", "segment").agg(
        F.min_by("page_id", order).alias("first_page"), F.max_by("page_id", order).alias("page_id")
    )
    over_segments = Window.partitionBy("session_id").orderBy("segment")
    carried = edges.select(
        "page_id",
        F.lead("first_page").over(over_segments).alias("next_page_id"),
        F.lit(1).cast("long").alias("steps"),
    )
    return inside.unionByName(carried)


def _matches(pair: tuple[int, int]) -> Column:
    return (F.col("page_id") == pair[0]) & (F.col("next_page_id") == pair[1])


def page_pair_counts(steps: DataFrame, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """Views of each observed target pair, anywhere in a session."""
    wanted = reduce(or_, [_matches(pair) for pair in sorted(set(pairs))], F.lit(False))
    return (
        steps.filter(wanted)
        .groupBy("page_id", "next_page_id")
        .agg(F.sum("steps").alias("pv"))
        .select(F.concat_ws("_", "page_id", "next_page_id").alias("pair"), "pv")
    )


def page_views(actions: DataFrame, page_id: int) -> DataFrame:
    """One row: the views of one page, as ``start_pv``."""
    return actions.agg(F.count_if(F.col("page_id") == page_id).alias("start_pv"))


def conversion_rates(steps: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Each step of the flow with its views and its rate against the step before.

    The first step is compared with the views of the start page. A pair that never occurs
    has rate 0; a zero denominator gives NULL. One pass over the steps fills one row of
    conditional sums, which is then laid out by position.
    """
    pairs = list(zip(flow, flow[1:]))
    if not pairs:
        raise ValueError("the target page flow needs at least two pages")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("steps"))), F.lit(0)).cast("long")

    sums = [total(F.col("page_id") == flow[0]).alias("pv_0")]
    sums += [total(_matches(pair)).alias(f"pv_{i}") for i, pair in enumerate(pairs, start=1)]
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f"{a}_{b}").alias("pair"),
            F.col(f"pv_{i}").alias("pv"),
            F.col(f"pv_{i - 1}").alias("previous_pv"),
        )
        for i, (a, b) in enumerate(pairs, start=1)
    ]
    return (
        steps.agg(*sums)
        .select(F.inline(F.array(*rows)))
        .withColumn(
            "rate", round_half_up(F.col("pv") / F.nullif(F.col("previous_pv"), F.lit(0)))
        )
    )


def conversion_text(rates: DataFrame) -> DataFrame:
    """The rates as one ``1_2=0.1|2_3=...`` text in flow order, as ``convert_rate``."""
    entry = F.concat(
        F.col("pair"), F.lit("="), F.coalesce(F.col("rate").cast("string"), F.lit("null"))
    )
    listed = F.array_sort(F.collect_list(F.struct("position", entry.alias("entry"))))
    return rates.agg(F.array_join(listed["entry"], "|").alias("convert_rate"))
