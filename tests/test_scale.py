"""The shape of the plans: what would decide the run time on a large cluster."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import ads, categories, pages, products, sampling, sessions
from clickloom.params import TaskParams
from clickloom.plans.queries import QUERIES
from clickloom.session import scratch_path, shared_folder
from clickloom.sinks.batch import replace_table
from clickloom.sources import tables

FOLDER = "/root/testdata/sf0.001"
BATCH = sorted(
    name for name in QUERIES if not name.startswith(("stream_", "sink_roundtrip"))
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shop(spark, log, rows):
    """The shop's tables as parquet files."""
    folder = scratch_path(spark, "shop")
    log(*[{"session_id": f"s{i}", "page_id": i % 7} for i in range(50)]).write.parquet(f"{folder}/a")
    people = [{"user_id": i, "age": 20, "sex": "male"} for i in range(3)]
    rows(schemas.USER_INFO, *people).write.parquet(f"{folder}/u")
    goods = [{"product_id": i} for i in range(3)]
    rows(schemas.PRODUCT_INFO, *goods).write.parquet(f"{folder}/p")
    return (
        tables.user_visit_actions(spark, f"{folder}/a"),
        tables.users(spark, f"{folder}/u"),
        tables.products(spark, f"{folder}/p"),
    )


@pytest.fixture(scope="module")
def params():
    return TaskParams("2017-11-10", "2017-11-31", start_age=20, end_age=50, keywords=("spa",))


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def in_order(plan, patterns):
    """The patterns' first places in a plan are in this order, from the result to the scan."""
    places = [re.search(pattern, plan).start() for pattern in patterns]
    return places == sorted(places)


def _scans(plan):
    return re.findall(r"FileScan parquet .*?ReadSchema: struct<(.*?)>", plan)


def test_product_scan_reads_three_columns_and_pushes_its_filters(shop, params):
    raw, _, goods = shop
    plan = plan_of(products.area_top_products(tables.product_clicks(raw, params), goods))
    assert "date:string,click_product_id:bigint,city_id:bigint" in _scans(plan)
    pushed = " ".join(re.findall(r"PushedFilters: \[.*?\]", plan))
    assert "GreaterThanOrEqual(date,2017-11-10)" in pushed
    assert "LessThanOrEqual(date,2017-11-31)" in pushed
    assert "IsNotNull(click_product_id)" in pushed


def test_ratios_build_no_sets_and_push_the_user_filter(shop, params):
    raw, people, _ = shop
    actions = tables.actions_in_range(raw, params)
    plan = plan_of(sessions.length_ratios(sessions.filtered_sessions(actions, people, params)))
    assert "collect_set" not in plan and "ObjectHashAggregate" not in plan
    assert "GreaterThanOrEqual(age,20), LessThanOrEqual(age,50)" in plan
    assert not any("click_category_id" in scan or "page_id" in scan for scan in _scans(plan))


def test_categories_combine_before_the_session_join(shop, params):
    raw, people, _ = shop
    actions = tables.actions_in_range(raw, params)
    chosen = sessions.filtered_sessions(actions, people, params)
    plan = plan_of(categories.category_session_counts(actions, chosen))
    order = [r"Join \[session_id", r"Exchange hashpartitioning\(session_id#\d+, category_id"]
    order += [r"keys=\[session_id#\d+, category_id#\d+L\], functions=\[partial_count", r"inline"]
    assert in_order(plan, order)


def test_clicks_combine_before_the_blacklist_join(spark):
    lines = spark.range(99).selectExpr("concat('1 0 0 ', id % 7, ' 5') AS value").repartition(3)
    listed = spark.range(3).withColumnRenamed("id", "user_id")
    plan = plan_of(ads.totals_without_users(ads.parse_clicks(lines), listed, broadcast_limit=2))
    order = [r"Join \[user_id", r"keys=\[date#\d+, user_id#\d+L, province.*partial_count"]
    assert in_order(plan, order)


def test_top_k_is_cut_before_the_shuffle(shop, params):
    raw, people, goods = shop
    actions = tables.actions_in_range(raw, params)
    chosen = sessions.filtered_sessions(actions, people, params)
    counts = categories.category_session_counts(actions)
    top = categories.top_categories(categories.category_counts(counts))
    assert "TakeOrderedAndProject" in plan_of(top)
    for frame, limit in (
        (products.area_top_products(tables.product_clicks(raw, params), goods), 3),
        (categories.top_sessions(counts, top), 10),
        (sampling.sample_sessions(chosen, 100), 100),
    ):
        assert f"row_number(), {limit}, Partial" in plan_of(frame)


def test_detail_of_few_sessions_does_not_shuffle_the_log(spark, shop, params):
    actions = tables.actions_in_range(shop[0], params)
    few = spark.createDataFrame([("s1",)], "session_id string")
    for frame in (
        categories.top_session_detail(actions, few),
        sampling.keep_actions_of(actions, few, 100),
    ):
        plan = plan_of(frame)
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    large = plan_of(sampling.keep_actions_of(actions, few.repartition(3), 10**6))
    assert "ResolvedHint" not in large


def test_ordinary_sessions_are_chained_in_one_shuffle(shop, params):
    """Without a heavy session there is no second path.

    The log is scanned once more before, to count the actions of each session.
    """
    steps = pages.conversion_rates(
        pages.page_steps(tables.actions_in_range(shop[0], params)), [1, 2, 3]
    )
    plan = plan_of(steps)
    assert len(re.findall(r"Window \[", plan)) == 1 and "min_by" not in plan and "Join" not in plan


def test_log_bucketed_by_session_is_not_shuffled(spark, shop, params):
    replace_table(shop[0], "bucketed_visits", bucket_by=("session_id", 4))
    actions = tables.actions_in_range(tables.user_visit_actions(spark, "bucketed_visits"), params)
    detail = sessions.session_detail(actions, actions.select("session_id").distinct())
    assert "Exchange hashpartitioning(session_id" not in plan_of(sessions.session_summary(actions))
    # Of the detail, the chosen ids alone may be.
    assert plan_of(detail).split("Initial Plan")[-1].count("Exchange hashpartitioning(session_id") <= 1


@contextmanager
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


ACTION = [
    "TIMESTAMP'2017-11-10 03:00:00' AS action_ts",
    "CAST(NULL AS STRING) AS search_keyword",
    "CAST(NULL AS LONG) AS click_category_id",
]
PERSON = ["id AS user_id", "30 AS age", "'a' AS professional", "'b' AS city", "'c' AS sex"]


def test_partition_of_a_hot_user_is_split(spark):
    """A third of the sessions belong to one user."""
    with small_skew_limits(spark):
        hot = "IF(id % 3 = 0, 0L, id) AS user_id"
        actions = spark.range(6000).selectExpr("concat('s', id) AS session_id", hot, *ACTION)
        people = spark.range(6000).selectExpr(*PERSON)
        found = sessions.filtered_sessions(actions, people, TaskParams("", ""))
        assert len(found.collect()) == 6000
        assert "SortMergeJoin(skew=true)" in plan_of(found)


def test_partition_of_a_hot_session_is_split(spark):
    """A third of the log is one session, and the users are broadcast."""
    with small_skew_limits(spark):
        hot = "IF(id % 3 = 0, 's', concat('s', id)) AS session_id"
        actions = spark.range(9000).selectExpr(hot, "id % 5 AS user_id", *ACTION)
        people = F.broadcast(spark.range(5).selectExpr(*PERSON))
        chosen = sessions.filtered_sessions(actions, people, TaskParams("", ""))
        detail = sessions.session_detail(actions, chosen)
        assert len(detail.collect()) == 9000
        assert "SortMergeJoin(skew=true)" in plan_of(detail)


def test_shared_folder_is_the_clusters(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
