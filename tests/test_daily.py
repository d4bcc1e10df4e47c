from __future__ import annotations

import glob
import random
from dataclasses import replace

import pytest

from clickloom.operators import categories, daily, sessions
from clickloom.session import scratch_path
from clickloom.sources.tables import actions_in_range

DATES = [f"2017-11-{d}" for d in range(10, 15)]


def _records(seed, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = rng.choice(["click", "order", "pay", "search"])
        out.append(
            {
                # A third of the log is one session, which goes over all days.
                "session_id": "hot" if i % 3 == 0 else rng.choice([None, *(f"s{k}" for k in range(30))]),
                "user_id": rng.choice([-1, 1, 2]),
                "date": (date := rng.choice(DATES)),
                "action_time": f"{date} {rng.randrange(24)}:00:{rng.randrange(60):02d}",
                "search_keyword": rng.choice(["", "tea", "tea,mint", "-1"]) if kind == "search" else None,
                "click_category_id": rng.randrange(5) if kind == "click" else -1,
                "order_category_ids": "1,2" if kind == "order" else None,
                "pay_category_ids": "4" if kind == "pay" else None,
            }
        )
    return out


@pytest.fixture(scope="module")
def stored(spark, log):
    """A log of five days, stored by date, and its partials."""
    folder = scratch_path(spark, "daily")
    log(*_records(1)).write.partitionBy("date").parquet(f"{folder}/log")
    raw = spark.read.schema(log({}).schema).parquet(f"{folder}/log")
    daily.refresh(raw, f"{folder}/partials", DATES)
    return raw, f"{folder}/partials"


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize(
    "filters",
    [
        {},
        {"start_date": "2017-11-11", "end_date": "2017-11-12"},
        {"keywords": ("mint",)},
        {"keywords": ("-1", "tea"), "category_ids": ("1", "3")},
    ],
)
def test_partials_merge_to_the_whole(spark, stored, people, november, filters):
    raw, folder = stored
    params = replace(november, **filters)
    actions = actions_in_range(raw, params)
    merged = daily.merged_sessions(daily.stored_sessions(spark, folder, params), params)
    want = sessions.filtered_sessions(actions, people, params)
    got = sessions.known_sessions(merged, people, params)
    assert _rows(got) == _rows(want)
    counts = daily.merged_categories(daily.stored_categories(spark, folder, params))
    assert _rows(counts) == _rows(categories.category_session_counts(actions))
    of_sessions = daily.merged_categories(daily.stored_categories(spark, folder, params), got)
    assert _rows(of_sessions) == _rows(categories.category_session_counts(actions, want))


def _files(folder):
    return {
        date: sorted(glob.glob(f"{folder}/*/date={date}/*.parquet")) for date in DATES
    }


def test_refresh_reads_and_writes_its_dates_alone(spark, log, november, people):
    folder = scratch_path(spark, "daily")
    log(*_records(2)).write.partitionBy("date").parquet(f"{folder}/log")
    schema = log({}).schema
    raw = spark.read.schema(schema).parquet(f"{folder}/log")
    daily.refresh(raw, f"{folder}/partials", DATES)
    before = _files(f"{folder}/partials")
    late = [r for r in _records(3) if r["date"] == DATES[2]]
    log(*late).write.mode("append").partitionBy("date").parquet(f"{folder}/log")
    raw = spark.read.schema(schema).parquet(f"{folder}/log")
    daily.refresh(raw, f"{folder}/partials", [DATES[2]])
    after = _files(f"{folder}/partials")
    assert [d for d in DATES if before[d] != after[d]] == [DATES[2]]
    wanted = raw.filter(raw.date.isin(DATES[2]))
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(date" in plan and f"= {DATES[2]})" in plan
    merged = daily.merged_sessions(daily.stored_sessions(spark, f"{folder}/partials", november))
    got = sessions.known_sessions(merged, people, november)
    want = sessions.filtered_sessions(actions_in_range(raw, november), people, november)
    assert _rows(got) == _rows(want)


def test_report_reads_the_folders_of_its_days(spark, stored, november):
    params = replace(november, start_date=DATES[1], end_date=DATES[1])
    rows = daily.stored_sessions(spark, stored[1], params)
    plan = rows._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(date" in plan.toString()
    rows.collect()
    assert {r.date for r in rows.collect()} == {DATES[1]}


def test_a_date_that_lost_its_actions_is_emptied(spark, log, stored, november):
    folder = scratch_path(spark, "daily")
    raw = log(*_records(4))
    daily.refresh(raw, folder, DATES)
    left = raw.filter(raw.date != DATES[0])
    daily.refresh(left, folder, [DATES[0]])
    params = replace(november, end_date=DATES[0])
    assert daily.stored_sessions(spark, folder, params).isEmpty()
    assert daily.stored_categories(spark, folder, params).isEmpty()
    whole = daily.merged_sessions(daily.stored_sessions(spark, folder, november))
    assert _rows(whole) == _rows(sessions.session_summary(actions_in_range(left, november)))
