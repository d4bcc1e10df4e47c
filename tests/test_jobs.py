"""The jobs as they are run from the command line, on the stand-in tables as files."""

from __future__ import annotations

import json

import pytest

from clickloom.__main__ import main
from clickloom.plans.queries import DAYS, QUERIES, THRESHOLD
from clickloom.session import scratch_path
from clickloom.sources import standins
from clickloom.streaming.ad_clicks import AdStore

FOLDER = "/root/testdata/sf0.01"
PARAMS = json.dumps(
    {
        "startDate": DAYS["start_date"],
        "endDate": DAYS["end_date"],
        "startAge": "20",
        "endAge": 50,
        "targetPageFlow": "1,2,3,4,5,6,7",
    }
)


@pytest.fixture(scope="module")
def shop(spark):
    folder = scratch_path(spark, "jobs")
    standins.user_visit_actions(spark, FOLDER).write.parquet(f"{folder}/actions")
    standins.users(spark, FOLDER).write.parquet(f"{folder}/users")
    standins.products(spark, FOLDER).write.parquet(f"{folder}/products")
    standins.ad_lines(spark, FOLDER).write.text(f"{folder}/ads")
    return folder


@pytest.mark.parametrize(
    "job, inputs, tables",
    [
        (
            "session",
            ["--users"],
            [
                "session_aggr_stat",
                "session_random_extract",
                "session_detail",
                "top10_category",
                "top10_session",
            ],
        ),
        ("page", [], ["page_split_convert_rate"]),
        ("product", ["--products"], ["area_top3_product"]),
    ],
)
def test_batch_job(spark, shop, job, inputs, tables):
    out = f"{shop}/out-{job}"
    paths = [part for name in ["--actions", *inputs] for part in (name, f"{shop}/{name[2:]}")]
    main([job, "--params", PARAMS, "--task-id", "task-1", "--out", out, *paths])
    for table in tables:
        got = spark.read.parquet(f"{out}/{table}")
        want = QUERIES[f"report_{table}"](spark, FOLDER)
        assert got.schema.names == want.schema.names
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_ads_job(spark, shop):
    main(
        ["ads", "--files", f"{shop}/ads", "--store", f"{shop}/store", "--available-now"]
        + ["--checkpoint", f"{shop}/checkpoint", "--threshold", str(THRESHOLD)]
        + ["--compact-every", "4"]
    )
    store = AdStore(f"{shop}/store")
    for log, query in (
        (store.totals, "ad_running_stat"),
        (store.province_top, "ad_province_top3"),
        (store.blacklist, "ad_blacklist_users"),
        (store.user_clicks, "ad_user_daily_clicks"),
        (store.trend, "ad_click_trend"),
    ):
        got, want = log.read(spark), QUERIES[query](spark, FOLDER)
        assert got.count() == want.count()
        assert got.exceptAll(want.select(*got.columns)).isEmpty()


def test_a_job_needs_a_destination(spark):
    with pytest.raises(SystemExit):
        main(["page", "--params", PARAMS])
