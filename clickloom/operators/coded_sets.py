"""Sets of words and categories as bits of dictionary codes.

A value's code is its place in a dictionary without gaps, the most frequent first. A
session's set is one row for each block of 64 codes that it has a member of, and the row's
64 bits are the members. Every aggregate on the way has a buffer of fixed width, so a session
with a million words is at most as many small rows, dealt over the tasks by (session, block);
as frequent codes are neighbours, an ordinary session is one or two rows. Which sessions hold
any of some values is a bit test that reads no text.

Against ``collect_set`` this costs a distinct and a join with the dictionary, once; what is
written then serves every task over the same days.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.predicates import MISSING, listed_in
from clickloom.operators.sessions import known_sessions, length_measures, summary_of
from clickloom.params import TaskParams
from clickloom.session import materialize

# A row's number holds its partition above these bits.
ROW_BITS = 33


class CodedSets(NamedTuple):
    """The values by ``code``, and each session's ``bits`` of a ``block`` of codes."""

    dictionary: DataFrame
    blocks: DataFrame


def _block() -> Column:
    return F.shiftright("code", 6).alias("block")


def _bits() -> Column:
    return F.bit_or(F.expr("shiftleft(1L, CAST(code & 63 AS INT))"))


def dictionary(pairs: DataFrame) -> DataFrame:
    """Each ``value`` of ``pairs`` with a ``code``: 0, 1, 2, ... by falling number of rows.

    Values of one count go by their own order. The rows are sorted by range and numbered
    inside each partition; only the sizes of the partitions go through one task.
    """
    counts = pairs.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("value")]
    ranged = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranged.select("value", F.monotonically_increasing_id().alias("_row"))
    placed = materialize(numbered, "dictionary").withColumn(
        "_part", F.shiftright("_row", ROW_BITS)
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("_part")) - F.col("n")
    # One row for each shuffle partition.
    starts = F.broadcast(sizes.select("_part", before.alias("_start")))
    inside = F.col("_row").bitwiseAND((1 << ROW_BITS) - 1)
    return placed.join(starts, "_part").select("value", (F.col("_start") + inside).alias("code"))


def coded_sets(actions: DataFrame, value: Column) -> CodedSets:
    """The set of ``value`` of each session; NULL is no member, and no session has no set.

    What the joins read is written first: they are then joins of plain scans, of which AQE
    splits a value that a large part of the sessions has.
    """
    rows = actions.select("session_id", value.alias("value"))
    known = rows.filter("session_id IS NOT NULL AND value IS NOT NULL").distinct()
    pairs = materialize(known, "session-values")
    codes = dictionary(pairs)
    coded = pairs.join(codes, "value")
    blocks = coded.groupBy("session_id", _block()).agg(_bits().alias("bits"))
    return CodedSets(codes, materialize(blocks, "session-bits"))


def sessions_with(sets: CodedSets, wanted: Column) -> DataFrame:
    """Sessions whose set has a value for which ``wanted`` is true."""
    listed = sets.dictionary.filter(wanted)
    marks = listed.groupBy(_block()).agg(_bits().alias("wanted"))
    joined = sets.blocks.join(materialize(marks, "wanted-bits"), "block")
    hit = F.col("bits").bitwiseAND(F.col("wanted")) != 0
    return joined.filter(hit).select("session_id").distinct()


def decoded(sets: CodedSets, sessions: DataFrame, name: str) -> DataFrame:
    """The sorted values of the given sessions as an array ``name``; none for an empty set.

    A block of the dictionary is one row of at most 64 values. The arrays of one session meet
    in one group, as the result holds them in one value.
    """
    place = F.col("code").bitwiseAND(63).cast("int").alias("place")
    block = sets.dictionary.groupBy(_block()).agg(
        F.collect_list(F.struct(place, "value")).alias("values")
    )
    members = F.filter("values", lambda entry: F.getbit("bits", entry["place"]) == 1)
    chosen = sets.blocks.join(sessions.select("session_id"), "session_id", "left_semi")
    parts = chosen.join(materialize(block, "dictionary-blocks"), "block").select(
        "session_id", F.transform(members, lambda entry: entry["value"]).alias("part")
    )
    whole = F.array_sort(F.flatten(F.collect_list("part")))
    return parts.groupBy("session_id").agg(whole.alias(name))


def coded_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """``sessions.filtered_sessions`` by coded sets.

    Sessions are chosen by their bits before any set is turned back into text.
    """
    words = coded_sets(actions, F.nullif(F.col("search_keyword"), F.lit("")))
    categories = coded_sets(actions, F.col("click_category_id"))
    known = actions.filter("session_id IS NOT NULL")
    sessions = known.groupBy("session_id").agg(*length_measures())
    found = []
    if params.keywords:
        found.append(sessions_with(words, listed_in(F.col("value"), params.keywords)))
        if MISSING in params.keywords:
            # Exactly "-1" as a session's only word never matches.
            found.append(sessions_with(words, F.col("value") != MISSING))
    if params.category_ids:
        wanted = F.col("value").cast("string").isin(*params.category_ids)
        found.append(sessions_with(categories, wanted))
    for hits in found:
        sessions = sessions.join(hits, "session_id", "left_semi")
    sessions = materialize(sessions, "coded-sessions")
    for sets, name in ((words, "keywords"), (categories, "categories")):
        sessions = sessions.join(decoded(sets, sessions, name), "session_id", "left")
    return known_sessions(summary_of(sessions), users, params)
