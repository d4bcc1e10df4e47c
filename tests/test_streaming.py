from __future__ import annotations

import glob
import random
from collections import Counter, defaultdict

import pytest

from clickloom import schemas
from clickloom.operators import ads
from clickloom.session import scratch_path
from clickloom.sinks.batch_log import SLOTS, BatchLog
from clickloom.streaming.ad_clicks import (
    AdSettings,
    AdStore,
    _dealt,
    apply_batch,
    start_ad_stats,
    start_click_trend,
    start_running_totals,
    state_totals,
)
from clickloom.streaming.sources import file_lines, kafka_lines, kafka_options

from conftest import records_read
from test_ads import stamp


class Feed:
    """Lines that arrive in a folder, and a stream that works through them."""

    def __init__(self, spark, start, **settings):
        self.spark, self.start = spark, start
        self.folder = scratch_path(spark, "feed")
        self.store = AdStore(f"{self.folder}/store")
        self.settings = AdSettings(**settings)
        self.published = []

    def arrive(self, lines):
        frame = self.spark.createDataFrame([(line,) for line in lines], "value string")
        frame.write.mode("append").text(f"{self.folder}/in")

    def run(self):
        query = self.start(
            file_lines(self.spark, f"{self.folder}/in"),
            self.store,
            f"{self.folder}/checkpoint",
            self.settings,
            publish=lambda *args: self.published.append((args[0], args[1].collect(), args[2])),
            available_now=True,
        )
        query.awaitTermination()
        return query


def _line(day, province, city, user, ad):
    return f"{stamp(f'2017-11-{day} 03:00:00')} {province} {city} {user} {ad}"


def _table(log, spark):
    return {tuple(row) for row in log.read(spark).collect()}


def _model(batches, threshold):
    """What the tables hold after the batches, by plain Python."""
    counts, banned, totals = Counter(), set(), Counter()
    for batch in batches:
        before = set(banned)
        for day, province, city, user, ad in batch:
            if user in before:
                continue
            counts[f"2017-11-{day}", user, ad] += 1
            totals[f"2017-11-{day}", str(province), str(city), ad] += 1
        banned |= {user for (_, user, _), n in counts.items() if n >= threshold}
    groups = defaultdict(Counter)
    for (date, province, _, ad), n in totals.items():
        groups[date, province][ad] += n
    top = {
        (*group, ad, n)
        for group, ranked in groups.items()
        for ad, n in sorted(ranked.items(), key=lambda item: (-item[1], item[0]))[:3]
    }
    return (
        {(*key, n) for key, n in counts.items()},
        {(user,) for user in banned},
        {(*key, n) for key, n in totals.items()},
        top,
    )


@pytest.mark.parametrize("compact_every", [1, 3])
def test_stream_equals_model_across_restarts(spark, compact_every):
    rng = random.Random(4)
    # User 0 makes a third of the clicks.
    batches = [
        [
            (
                rng.choice([10, 11]) + i // 2,
                rng.randrange(2),
                rng.randrange(3),
                rng.choice([0, rng.randrange(1, 6), rng.randrange(1, 6)]),
                rng.randrange(4),
            )
            for _ in range(60)
        ]
        for i in range(4)
    ]
    feed = Feed(spark, start_ad_stats, threshold=7, compact_every=compact_every)
    for batch in batches:
        feed.arrive([_line(*click) for click in batch])
        feed.run()
    counts, banned, totals, top = _model(batches, 7)
    assert banned and len(banned) < 6
    store = feed.store
    assert _table(store.user_clicks, spark) == counts
    assert _table(store.blacklist, spark) == banned
    assert _table(store.totals, spark) == totals
    assert _table(store.province_top, spark) == top
    # What is published for a key last is what the table holds.
    last = {}
    for name, rows, _ in feed.published:
        if name == "ad_stat":
            last.update({tuple(row)[:4]: row.click_count for row in rows})
    assert {(*key, n) for key, n in last.items()} == totals


def test_several_batches_in_one_run_count_every_line_once(spark):
    rng = random.Random(9)
    feed = Feed(spark, start_ad_stats, threshold=10**6, compact_every=3)
    clicks = []
    for _ in range(5):
        part = [(10, 1, 1, rng.randrange(9), rng.randrange(9)) for _ in range(20)]
        clicks += part
        feed.arrive([_line(*click) for click in part] + ["junk", "a b c d e"])
    start = feed.start
    feed.start = lambda lines, *args, **kwargs: start(
        file_lines(spark, f"{feed.folder}/in", files_per_batch=4), *args, **kwargs
    )
    query = feed.run()
    seen = [p.observedMetrics["ad_lines"] for p in query.recentProgress if p.observedMetrics]
    assert sum(m["line_count"] for m in seen) == 110
    assert sum(m["malformed_count"] for m in seen) == 10
    assert len({n for _, _, n in feed.published}) > 1
    assert _table(feed.store.totals, spark) == _model([clicks], 10**6)[2]


def test_replaying_a_batch_changes_nothing(spark):
    store, settings = AdStore(scratch_path(spark, "replay")), AdSettings(threshold=2, compact_every=2)

    def batch(*clicks):
        lines = spark.createDataFrame([(_line(*click),) for click in clicks], "value string")
        return ads.parse_clicks(lines)

    first = batch((10, 1, 1, 5, 5), (10, 1, 1, 5, 5), (10, 1, 1, 6, 5))
    second = batch((10, 1, 1, 5, 5), (10, 1, 2, 7, 5))
    apply_batch(first, 0, store, settings)
    apply_batch(second, 1, store, settings)
    logs = (store.blacklist, store.user_clicks, store.totals, store.province_top)
    once = [_table(log, spark) for log in logs]
    apply_batch(second, 1, store, settings)
    assert [_table(log, spark) for log in logs] == once
    assert once[0] == {(5,)}
    assert once[2] == {("2017-11-10", "1", "1", 5, 3), ("2017-11-10", "1", "2", 5, 1)}


def test_trend_counts_clicks_of_blacklisted_users_and_late_ones(spark):
    feed = Feed(spark, start_click_trend, compact_every=2)

    def at(clock, ad=1, day="2017-11-10"):
        return f"{stamp(day + ' ' + clock)} 0 0 1 {ad}"

    feed.arrive([at("10:00:01"), at("10:00:59"), at("10:01:00")])
    feed.run()
    feed.arrive([at("09:30:00"), at("10:00:30"), at("12:00:00", 2)])
    feed.run()
    # Hours and days late.
    feed.arrive([at("10:00:30"), at("12:00:10", 2), at("23:59:59", day="2017-11-07")])
    query = feed.run()
    assert all(not p["stateOperators"] for p in query.recentProgress)
    assert _table(feed.store.trend, spark) == {
        ("2017-11-10", "10", "00", 1, 4),
        ("2017-11-10", "10", "01", 1, 1),
        ("2017-11-10", "09", "30", 1, 1),
        ("2017-11-10", "12", "00", 2, 2),
        ("2017-11-07", "23", "59", 1, 1),
    }


def test_late_clicks_of_a_user_count_and_blacklist(spark):
    feed = Feed(spark, start_ad_stats, threshold=3)
    feed.arrive([_line(10, 1, 1, 5, 5)] * 2)
    feed.run()
    feed.arrive([_line(20, 1, 1, 6, 5)])
    feed.run()
    feed.arrive([_line(10, 1, 1, 5, 5), _line(20, 1, 1, 6, 5)])
    query = feed.run()
    assert all(not p["stateOperators"] for p in query.recentProgress)
    assert _table(feed.store.user_clicks, spark) == {
        ("2017-11-10", 5, 5, 3),
        ("2017-11-20", 6, 5, 2),
    }
    assert _table(feed.store.blacklist, spark) == {(5,)}


def test_state_of_a_resumed_stream_is_read_back(spark):
    feed = Feed(spark, start_running_totals)
    batches = [[(10, 1, c, u, u % 3) for u in range(6)] for c in (1, 2, 1)]
    for batch in batches:
        feed.arrive([_line(*click) for click in batch] + ["junk"])
        feed.run()
    want = _model(batches, 10**6)[2]
    state = state_totals(spark, f"{feed.folder}/checkpoint")
    assert {tuple(row) for row in state.collect()} == want
    # What was published last for a key is what the state holds; only changed keys are.
    last = {tuple(row)[:4]: row.click_count for _, rows, _ in feed.published for row in rows}
    assert {(*key, n) for key, n in last.items()} == want
    assert [len(rows) for _, rows, _ in feed.published if rows] == [3, 3, 3]


def test_streaming_totals_in_complete_mode(spark):
    folder = scratch_path(spark, "complete")
    spark.createDataFrame([(_line(10, 1, 1, 5, 5),)] * 3, "value string").write.text(folder)
    totals = ads.running_totals(ads.parse_clicks(file_lines(spark, folder)))
    query = totals.writeStream.outputMode("complete").format("memory").queryName("all_totals")
    query.trigger(availableNow=True).start().awaitTermination()
    assert [tuple(r) for r in spark.table("all_totals").collect()] == [("2017-11-10", "1", "1", 5, 3)]


@pytest.fixture
def totals_log(spark):
    return BatchLog(
        scratch_path(spark, "log"),
        schemas.AD_USER_CLICK_COUNT,
        ["date", "user_id", "ad_id"],
        "sum",
        "click_count",
        segment="date",
    )


def _partitions(log):
    return {
        name[len(log.path) + 1 :].rsplit("/", 1)[0]
        for name in glob.glob(f"{log.path}/**/*.parquet", recursive=True)
    }


def test_folding_keeps_the_table(spark, totals_log):
    want = Counter()
    for batch_id in range(8):
        data = [(f"2017-11-{10 + batch_id // 3}", user, 1, 1 + batch_id) for user in range(3)]
        for row in data:
            want[row[:3]] += row[3]
        if batch_id % 2:
            totals_log.fold(spark, batch_id - 1)
        totals_log.write(spark.createDataFrame(data, schemas.AD_USER_CLICK_COUNT), batch_id)
        assert _table(totals_log, spark) == {(*key, n) for key, n in want.items()}
        # As another process reads it, and as the next batch does.
        other = BatchLog(
            totals_log.path, schemas.AD_USER_CLICK_COUNT, totals_log.keys, "sum", "click_count", "date"
        )
        assert _table(other, spark) == _table(totals_log, spark)
        assert {tuple(r) for r in totals_log.read(spark, batch_id).collect()} == _table(other, spark)
    folded = {p for p in _partitions(totals_log) if p.endswith("=-1")}
    assert folded == {f"date=2017-11-{d}/batch_slot=-1" for d in (10, 11, 12)}


def test_only_dates_that_changed_are_folded_again(spark, totals_log):
    def write(date, batch_id):
        row = spark.createDataFrame([(date, 1, 1, 5)], schemas.AD_USER_CLICK_COUNT)
        totals_log.write(row, batch_id)

    write("2017-11-10", 0)
    totals_log.fold(spark, 0)
    old = glob.glob(f"{totals_log.path}/date=2017-11-10/batch_slot=-1/*.parquet")
    write("2017-11-11", 1)
    totals_log.fold(spark, 1)
    totals_log.fold(spark, 2)
    assert glob.glob(f"{totals_log.path}/date=2017-11-10/batch_slot=-1/*.parquet") == old
    assert _table(totals_log, spark) == {("2017-11-10", 1, 1, 5), ("2017-11-11", 1, 1, 5)}


def test_a_fold_that_was_cut_off_is_harmless(spark, totals_log):
    """Of two dates, one was folded when the job died; the batch after it is replayed."""
    days = [("2017-11-10", 1, 1, 5), ("2017-11-11", 1, 1, 6)]
    for batch_id in range(3):
        totals_log.write(spark.createDataFrame(days, schemas.AD_USER_CLICK_COUNT), batch_id)
    late = BatchLog(
        totals_log.path, schemas.AD_USER_CLICK_COUNT, totals_log.keys, "sum", "click_count", "date"
    )
    half = late._merge(late._rows(spark, 2).filter("date = '2017-11-10'"))
    late._overwrite(half.selectExpr("*", "2L AS b", "-1 AS batch_slot").drop("batch_id").withColumnRenamed("b", "batch_id"))
    want = {("2017-11-10", 1, 1, 15), ("2017-11-11", 1, 1, 18)}
    assert _table(late, spark) == want
    late.fold(spark, 2)
    assert _table(late, spark) == want
    late.write(spark.createDataFrame(days, schemas.AD_USER_CLICK_COUNT), 3)
    assert _table(late, spark) == {("2017-11-10", 1, 1, 20), ("2017-11-11", 1, 1, 24)}


@pytest.mark.parametrize("mode, want", [
    ("insert", {("d", 1, 0), ("d", 2, 0), ("d", 3, 0)}),
    ("latest", {("d", 1, 11), ("d", 2, 20), ("d", 3, 31)}),
    ("replace_group", {("d", 1, 11), ("d", 3, 31)}),
])
def test_modes_after_folds_and_reused_slots(spark, mode, want, monkeypatch):
    monkeypatch.setattr("clickloom.sinks.batch_log.SLOTS", 4)
    keys = ["date", "k"] if mode != "replace_group" else ["date"]
    schema = "date string, k long, v long" if mode != "insert" else "date string, k long"
    schema = spark.createDataFrame([], schema).schema
    log = BatchLog(scratch_path(spark, "log"), schema, keys, mode, "v", segment="date")
    batches = {0: [("d", 1, 10), ("d", 2, 20)], 5: [("d", 1, 11), ("d", 3, 31)]}
    for batch_id in range(11):
        if batch_id % 2 == 0:
            log.fold(spark, batch_id - 1)
        rows = [row[: len(schema)] for row in batches.get(batch_id, [])]
        for _ in range(2):  # a replay
            log.write(spark.createDataFrame(rows, schema), batch_id)
    got = {(*r, 0)[:3] for r in _table(log, spark)}
    assert got == want


def test_unfinished_batch_is_not_read(spark, totals_log):
    row = spark.createDataFrame([("2017-11-10", 1, 1, 5)], schemas.AD_USER_CLICK_COUNT)
    totals_log.write(row, 0)
    # What a writer that died leaves is in a hidden folder.
    row.write.parquet(f"{totals_log.path}/.spark-staging-x/date=2017-11-10/batch_slot=1")
    assert _table(totals_log, spark) == {("2017-11-10", 1, 1, 5)}
    totals_log.write(row, 1)
    assert _table(totals_log, spark) == {("2017-11-10", 1, 1, 10)}


def test_a_batch_looks_up_its_own_dates_and_ads(spark):
    """Of 120,000 stored totals, a batch of few ads takes up some pages."""
    store = AdStore(scratch_path(spark, "store"))
    many = spark.range(40_000).selectExpr(
        "explode(array('1970-01-01', '2017-11-10', '2017-11-11')) AS date",
        "CAST(id % 2 AS STRING) AS province", "'0' AS city", "id AS ad_id", "5L AS click_count",
    )
    store.totals.write(many, 0)
    store.totals.fold(spark, 0)
    touched = [("2017-11-10", "1", "0", 7, 1), ("2017-11-10", "0", "0", 30_000, 1), ("1970-01-01", "1", "9", 7, 1)]
    store.totals.write(spark.createDataFrame(touched, schemas.AD_STAT), 1)
    written = store.totals.written(spark, 1)
    found = []
    columns = ["date", "province", "ad_id"]
    read = records_read(
        spark, lambda: found.extend(store.totals.matching(spark, 1, written, columns).collect())
    )
    assert {tuple(r) for r in found} == {
        ("2017-11-10", "1", "0", 7, 6), ("2017-11-10", "0", "0", 30_000, 6),
        ("1970-01-01", "1", "0", 7, 5), ("1970-01-01", "1", "9", 7, 1),
    }
    # Two ads of two dates: a page of 1,000 rows each, and the batch itself a few times.
    assert read <= 4 * 1_000 + 50
    assert records_read(spark, lambda: store.totals.read(spark).collect()) >= 120_000


def test_top_ads_are_merged_not_counted_again(spark):
    """The batch after a large one takes up the totals of its ads, not those of the day."""
    store, settings = AdStore(scratch_path(spark, "store")), AdSettings(compact_every=1)
    lines = [_line(10, 1, 1, ad % 50, ad) for ad in range(30_000)] + [_line(10, 1, 1, 1, 5)]
    first = ads.parse_clicks(spark.createDataFrame([(x,) for x in lines], "value string").cache())
    apply_batch(first, 0, store, settings)
    few = [_line(10, 1, 1, 60, 29_999)] * 3 + [_line(10, 1, 1, 61, 5)]
    second = ads.parse_clicks(spark.createDataFrame([(x,) for x in few], "value string"))
    apply_batch(second, 1, store, settings)
    once = _table(store.province_top, spark)
    assert once == {
        ("2017-11-10", "1", 29_999, 4), ("2017-11-10", "1", 5, 3), ("2017-11-10", "1", 0, 1)
    }
    # Folding the first batch reads all of it. Its replay folds nothing.
    read = records_read(spark, lambda: apply_batch(second, 1, store, settings))
    assert _table(store.province_top, spark) == once
    assert read < 15_000


@pytest.mark.parametrize("start", [start_ad_stats, start_click_trend])
def test_each_job_reads_its_source_once(spark, start):
    feed = Feed(spark, start, source_partitions=3)
    feed.arrive([_line(10, 1, 1, user, 5) for user in range(10)])
    assert feed.run().recentProgress[0]["numInputRows"] == 10


def test_lines_are_dealt_over_partitions(spark):
    lines = spark.range(100).selectExpr("CAST(id AS STRING) AS value").coalesce(1)
    assert _dealt(lines, AdSettings(source_partitions=5)).rdd.getNumPartitions() == 5
    assert _dealt(lines, AdSettings()) is lines


def test_settings_keep_a_fold_before_a_slot_is_taken_again():
    for batches in (0, SLOTS):
        with pytest.raises(ValueError):
            AdSettings(compact_every=batches)


def test_kafka_options():
    assert kafka_options(None, None) == {}
    assert kafka_options("ads", 5000) == {"groupIdPrefix": "ads", "maxOffsetsPerTrigger": "5000"}


def test_kafka_source_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_lines(spark, "localhost:9092", "ad-clicks")
