from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from clickloom.operators import coded_sets, sessions
from clickloom.sources.tables import actions_in_range


def words_of(actions):
    return coded_sets.coded_sets(actions, F.nullif(F.col("search_keyword"), F.lit("")))


def members(sets):
    """The sets as Python sets of values, read from the bits."""
    values = {row.code: row.value for row in sets.dictionary.collect()}
    found = {}
    for row in sets.blocks.collect():
        own = found.setdefault(row.session_id, set())
        own.update(values[row.block * 64 + i] for i in range(64) if row.bits >> i & 1)
    return found


def test_codes_are_dense_and_by_frequency(spark):
    # The largest value is the most frequent; each place of a block is used, the sign bit too.
    pairs = spark.range(200).select(
        F.explode(F.transform(F.sequence(F.lit(0), "id"), lambda k: 199 - k)).alias("value")
    )
    rows = coded_sets.dictionary(pairs).collect()
    assert {row.value: row.code for row in rows} == {199 - k: k for k in range(200)}


def test_ties_go_by_value(spark):
    pairs = spark.createDataFrame([("b",), ("c",), ("a",), ("c",)], "value string")
    codes = {row.value: row.code for row in coded_sets.dictionary(pairs).collect()}
    assert codes == {"c": 0, "a": 1, "b": 2}


def test_bits_are_the_sets(log):
    draw = random.Random(5)
    records = [
        {
            "session_id": draw.choice(["a", "b", "c", None]),
            "search_keyword": draw.choice([None, "", *[f"w{i}" for i in range(150)]]),
        }
        for _ in range(900)
    ]
    want = {}
    for record in records:
        if record["session_id"] and record["search_keyword"]:
            want.setdefault(record["session_id"], set()).add(record["search_keyword"])
    assert members(words_of(log(*records))) == want


@pytest.mark.parametrize(
    "filters",
    [
        {},
        {"keywords": ("tea", "x")},
        {"keywords": ("-1",)},
        {"keywords": ("-1", "tea")},
        {"keywords": ("nowhere",)},
        {"category_ids": ("1", "12")},
        {"category_ids": ("-1",)},
        {"keywords": ("tea", "-1"), "category_ids": ("2", "1"), "sex": "male"},
    ],
)
def test_same_sessions_as_by_plain_sets(log, people, november, filters):
    draw = random.Random(11)
    words = [None, "", "-1", "tea", "green tea", "tea,-1", "x,y", "-1,z", "é", "Tea"]
    records = [
        {
            "session_id": draw.choice([None, *[f"s{i}" for i in range(60)]]),
            "user_id": draw.choice([1, 2, -1, 77]),
            "search_keyword": draw.choice(words),
            "click_category_id": draw.choice([-1, None, 1, 2, 12, 100]),
            "action_time": f"2017-11-10 3:00:{draw.randrange(10, 60)}",
        }
        for _ in range(160)
    ]
    params = replace(november, **filters)
    actions = actions_in_range(log(*records), params)
    got = coded_sets.coded_sessions(actions, people, params)
    want = sessions.filtered_sessions(actions, people, params)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_empty_log(log, people, november):
    params = replace(november, keywords=("tea",))
    actions = actions_in_range(log({"date": "2018-01-01"}), params)
    assert coded_sets.coded_sessions(actions, people, params).collect() == []


def test_session_of_a_million_words(spark):
    million = 1_000_000
    actions = spark.range(million + 1000).select(
        F.when(F.col("id") < million, "hot")
        .otherwise(F.concat(F.lit("s"), F.col("id")))
        .alias("session_id"),
        F.concat(F.lit("word "), F.col("id") % million).alias("search_keyword"),
    )
    sets = words_of(actions)
    hot = sets.blocks.filter("session_id = 'hot'")
    # All of it is a row of eight bytes for 64 words.
    assert hot.count() == million // 64
    assert hot.agg(F.sum(F.bit_count("bits")).alias("n")).first().n == million
    some = coded_sets.sessions_with(sets, F.col("value") == "word 7").collect()
    assert {row.session_id for row in some} == {"hot", f"s{million + 7}"}
    one = coded_sets.decoded(sets, hot.select("session_id").distinct(), "keywords").first()
    assert one.keywords == sorted(f"word {i}" for i in range(million))


def test_sets_are_tested_without_texts_or_unbounded_buffers(log):
    actions = log(*[{"session_id": f"s{i}", "search_keyword": f"w{i % 7}"} for i in range(40)])
    sets = words_of(actions)
    plan = coded_sets.sessions_with(sets, F.col("value") == "w3")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "collect_" not in text and "value" not in text and "Window" not in text
    assert "Python" not in text
