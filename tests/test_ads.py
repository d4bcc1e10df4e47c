from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.operators import ads

IDS = st.integers(-(2**63), 2**63 - 1)


def stamp(text):
    moment = datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)
    return int(moment.timestamp() * 1000)


@pytest.fixture(scope="module")
def clicks(spark):
    def make(*lines):
        return ads.parse_clicks(spark.createDataFrame([(line,) for line in lines], "value string"))

    return make


def test_parse(spark, clicks):
    lines = [
        f"{stamp('2017-11-10 03:04:05')} 7 8 9 10",
        f"{stamp('2017-11-10 03:04:05')} 7 8 9 10 more",
        "1 2 3 4",
        "x 7 8 9 10",
        "1 7 8 x 10",
        "1 7 8 9 x",
        f"{2**63 - 1} 7 8 9 10",
        f"{2**63} 7 8 9 10",
        "",
    ]
    got = clicks(*lines).collect()
    assert len(got) == 2
    assert (got[0].date, got[0].province, got[0].city) == ("2017-11-10", "7", "8")
    assert (got[0].user_id, got[0].ad_id) == (9, 10)
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    assert tuple(ads.line_quality(frame).first()) == (9, 7)


def test_blacklist_needs_one_ad_on_one_day(clicks):
    day, next_day = stamp("2017-11-10 03:00:00"), stamp("2017-11-11 03:00:00")
    lines = [f"{day} 0 0 1 5"] * 3
    lines += [f"{day} 0 0 2 5"] * 2 + [f"{next_day} 0 0 2 5"] + [f"{day} 0 0 2 6"]
    found = ads.blacklisted_users(ads.user_daily_clicks(clicks(*lines)), 3)
    assert [r.user_id for r in found.collect()] == [1]


def test_top_ads_rank_within_province_and_day(clicks):
    lines = []
    for day, counts in (("2017-11-10", [5, 4, 3, 3, 1]), ("2017-11-11", [1, 9])):
        for ad, count in enumerate(counts):
            # Two cities of one province.
            lines += [f"{stamp(day + ' 03:00:00')} 1 {i % 2} {i} {ad}" for i in range(count)]
    top = ads.top_ads_by_province(ads.running_totals(clicks(*lines)))
    assert {(r.date, r.ad_id, r.click_count) for r in top.collect()} == {
        ("2017-11-10", 0, 5),
        ("2017-11-10", 1, 4),
        ("2017-11-10", 2, 3),
        ("2017-11-11", 0, 1),
        ("2017-11-11", 1, 9),
    }


def test_sliding_trend_equals_brute_force(clicks):
    rng = random.Random(2)
    start = datetime(2017, 11, 10, 3, 0, 0)
    moments = [(start + timedelta(seconds=rng.randrange(120)), rng.randrange(3)) for _ in range(60)]
    lines = [f"{stamp(str(moment))} 0 0 1 {ad}" for moment, ad in moments]
    got = Counter()
    for row in ads.sliding_click_trend(clicks(*lines), "2 minutes", "10 seconds").collect():
        got[str(row.window_end), f"{row.date} {row.hour}:{row.minute}", row.ad_id] += row.click_count
    want = Counter()
    for moment, ad in moments:
        slot = moment - timedelta(seconds=moment.second % 10)
        for i in range(1, 13):
            end = slot + timedelta(seconds=10 * i)
            want[str(end), f"{moment:%Y-%m-%d %H:%M}", ad] += 1
    assert got == want


@pytest.mark.parametrize("broadcast_limit", [0, 1, 2, 10])
def test_totals_without_users_on_either_path(spark, clicks, broadcast_limit):
    day = stamp("2017-11-10 03:00:00")
    lines = [f"{day} 0 {i % 2} {i % 5} 7" for i in range(50)]
    users = spark.createDataFrame([(0,), (3,)], "user_id long")
    totals = ads.totals_without_users(clicks(*lines), users, broadcast_limit)
    assert {tuple(row) for row in totals.collect()} == {
        ("2017-11-10", "0", "0", 7, 15),
        ("2017-11-10", "0", "1", 7, 15),
    }


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    users=st.lists(st.one_of(IDS, st.integers(-40_000, 70_000)), max_size=30),
    others=st.lists(st.one_of(st.none(), IDS, st.integers(-40_000, 70_000)), max_size=30),
)
def test_bitmap_leaves_out_exactly_the_listed(spark, users, others):
    neighbours = [u + d for u in users for d in (-32_768, -1, 0, 1, 8, 32_768) if abs(u + d) < 2**63]
    rows = spark.createDataFrame([(u,) for u in users + others + neighbours], "user_id long")
    bitmap = ads.user_bitmap(spark.createDataFrame([(u,) for u in users], "user_id long"))
    kept = Counter(r.user_id for r in ads.without_bitmap(rows, bitmap).collect())
    want = Counter(u for u in users + others + neighbours if u not in set(users))
    assert kept == want
    listed = spark.createDataFrame([(u,) for u in set(users)], "user_id long")
    assert Counter(r.user_id for r in ads.without_listed(rows, listed).collect()) == want


def test_bitmap_of_dense_ids_is_small(spark):
    users = spark.range(1, 300_000).withColumnRenamed("id", "user_id")
    size = ads.user_bitmap(users).selectExpr("count(*)", "sum(octet_length(bitmap))").first()
    assert tuple(size) == (10, 40_960)
    rows = spark.createDataFrame([(5,), (300_000,)], "user_id long")
    plan = ads.without_listed(rows, users)._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan
    sparse = users.selectExpr("user_id * 1000003 AS user_id")
    plan = ads.without_listed(rows, sparse)._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap" not in plan


@pytest.mark.parametrize("length, slide", [(120, 10), (60, 20), (60, 60)])
def test_window_runs_equal_the_copies(spark, clicks, length, slide):
    rng = random.Random(length + slide)
    start = datetime(2017, 11, 10, 23, 58, 0)
    moments = [(start + timedelta(seconds=rng.randrange(200)), rng.randrange(2)) for _ in range(60)]
    frame = clicks(*[f"{stamp(str(moment))} 0 0 1 {ad}" for moment, ad in moments])
    runs = ads.window_runs(ads.slot_counts(frame), length, slide)
    found, last = {}, {}
    for r in sorted(runs.collect(), key=lambda r: r.first_end):
        minute = (r.date, r.hour, r.minute, r.ad_id)
        # Runs do not overlap, and where two meet the count changes.
        if minute in last:
            assert r.first_end > last[minute].last_end
            if r.first_end - last[minute].last_end == timedelta(seconds=slide):
                assert r.click_count != last[minute].click_count
        last[minute] = r
        end = r.first_end
        while end <= r.last_end:
            found[(end, *minute)] = r.click_count
            end += timedelta(seconds=slide)
    copies = ads.sliding_click_trend(frame, f"{length} seconds", f"{slide} seconds")
    assert found == {tuple(r)[:-1]: r.click_count for r in copies.collect()}
    shown = ads.shown_in_window(runs, F.lit("2017-11-11 00:00:00").cast("timestamp")).collect()
    assert len(shown) == sum(str(end) == "2017-11-11 00:00:00" for end, *_ in found)


def test_window_runs_need_whole_slides(spark, clicks):
    with pytest.raises(ValueError):
        ads.window_runs(ads.slot_counts(clicks()), 60, 25)
