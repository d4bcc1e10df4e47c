from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickloom.operators import sampling


def _expected_quota(counts, size):
    days = defaultdict(dict)
    for (date, hour), count in counts.items():
        days[date][hour] = count
    totals = {date: sum(hours.values()) for date, hours in days.items()}
    per_day = dict.fromkeys(days, 0)
    # One session at a time to the day with the fewest so far that has more, then by date.
    for _ in range(min(size, sum(totals.values()))):
        open_days = [date for date in days if per_day[date] < totals[date]]
        per_day[min(open_days, key=lambda date: (per_day[date], date))] += 1
    quota = {}
    for date, hours in days.items():
        total = totals[date]
        share = {hour: divmod(count * per_day[date], total) for hour, count in hours.items()}
        spare = per_day[date] - sum(base for base, _ in share.values())
        first = sorted(hours, key=lambda hour: (-share[hour][1], hour))[:spare]
        for hour, (base, _) in share.items():
            quota[date, hour] = base + (hour in first)
    return quota


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    counts=st.dictionaries(
        st.tuples(st.sampled_from([f"2017-11-{d}" for d in range(10, 16)]),
                  st.sampled_from([f"{h:02d}" for h in range(24)])),
        st.integers(1, 400),
        min_size=1,
        max_size=40,
    ),
    size=st.integers(1, 200),
)
def test_quota(spark, counts, size):
    hourly = spark.createDataFrame(
        [(*key, count) for key, count in counts.items()],
        "date string, hour string, session_count long",
    )
    rows = sampling.sample_quota(hourly, size).collect()
    got = {(r.date, r.hour): r.quota for r in rows}
    assert got == _expected_quota(counts, size)
    assert all(0 <= quota <= counts[key] for key, quota in got.items())
    assert sum(got.values()) == min(size, sum(counts.values()))


@pytest.fixture(scope="module")
def sessions(spark):
    rng = random.Random(3)
    data = []
    for i in range(900):
        # One hour holds a third of the sessions.
        hour = 5 if i % 3 == 0 else rng.randrange(24)
        data.append((f"s{i}", f"2017-11-{10 + i % 4} {hour:02d}:00:00"))
    return spark.createDataFrame(data, "session_id string, start_time string")


def test_sample_fills_the_quota_without_replacement(sessions):
    drawn = sampling.sample_sessions(sessions, 100, seed=1).collect()
    assert len(drawn) == len({r.session_id for r in drawn}) == 100
    quota = sampling.sample_quota(sampling.hourly_session_counts(sessions), 100).collect()
    taken = Counter((r.date, r.hour) for r in drawn)
    assert {(r.date, r.hour): r.quota for r in quota if r.quota} == dict(taken)


def test_hourly_counts_of_text_dates(spark):
    # Dates are text: one of these is not a day.
    starts = [f"2019-0{2 + i % 3}-30 {i * i % 24:02d}" for i in range(40)]
    frame = spark.createDataFrame(
        [(f"s{i}", f"{start}:00:00") for i, start in enumerate(starts)],
        "session_id string, start_time string",
    )
    got = sampling.hourly_session_counts(frame).collect()
    assert {f"{r.date} {r.hour}": r.session_count for r in got} == Counter(starts)


def test_sample_depends_on_the_seed_alone(sessions):
    def ids(frame, seed):
        return {r.session_id for r in sampling.sample_sessions(frame, 100, seed).collect()}

    assert ids(sessions, 1) == ids(sessions.repartition(7), 1) != ids(sessions, 2)


def test_no_sessions(sessions):
    assert sampling.sample_sessions(sessions.filter("session_id = 'none'")).count() == 0


def test_more_days_than_samples(sessions):
    drawn = sampling.sample_sessions(sessions, 3).collect()
    assert sorted(r.date for r in drawn) == ["2017-11-10", "2017-11-11", "2017-11-12"]


def test_extract_report(spark, log, november):
    from clickloom.sources.tables import actions_in_range

    actions = actions_in_range(
        log(
            {"session_id": "a", "search_keyword": "tent", "click_category_id": 4},
            {"session_id": "a", "search_keyword": "coat"},
            {"session_id": "b"},
            {"session_id": "not drawn"},
        ),
        november,
    )
    drawn = spark.createDataFrame(
        [("a", "2017-11-10 03:00:00"), ("b", "2017-11-10 03:00:00")],
        "session_id string, start_time string",
    )
    got = {tuple(r) for r in sampling.extract_report(actions, drawn).collect()}
    assert got == {
        ("a", "2017-11-10 03:00:00", "coat,tent", "4"),
        ("b", "2017-11-10 03:00:00", None, None),
    }
    assert sampling.keep_actions_of(actions, drawn, 10**6).count() == 3
