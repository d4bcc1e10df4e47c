from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.plans.reports import session_report, write_report
from clickloom.session import scratch_path
from clickloom.sinks import batch, merge, zorder
from clickloom.sources import tables
from clickloom.sources.jdbc import JdbcTarget

from conftest import records_read


@pytest.fixture
def counts(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "date string, ad_id long, click_count long")

    return make


def _set(frame):
    return {tuple(row) for row in frame.collect()}


def test_merges(counts):
    stored = counts(("d1", 1, 5), ("d1", 2, 6), ("d2", 1, 7))
    new = counts(("d1", 1, 1), ("d3", 1, 2))
    keys = ["date", "ad_id"]
    assert _set(merge.insert_new(stored, new, keys)) == {
        ("d1", 1, 5), ("d1", 2, 6), ("d2", 1, 7), ("d3", 1, 2)
    }
    assert _set(merge.add_counts(stored, new, keys, "click_count")) == {
        ("d1", 1, 6), ("d1", 2, 6), ("d2", 1, 7), ("d3", 1, 2)
    }
    assert _set(merge.overwrite_rows(stored, new, keys)) == {
        ("d1", 1, 1), ("d1", 2, 6), ("d2", 1, 7), ("d3", 1, 2)
    }
    assert _set(merge.overwrite_rows(stored, new, ["date"])) == {
        ("d1", 1, 1), ("d2", 1, 7), ("d3", 1, 2)
    }


def test_csv_quotes_commas(spark, rows):
    users = rows(schemas.USER_INFO, {"user_id": 1, "username": 'a,b "c"', "age": 3})
    path = scratch_path(spark, "csv")
    batch.export_csv(users, path)
    back = spark.read.schema(schemas.USER_INFO).option("escape", '"').csv(path)
    assert _set(back) == _set(users)


def test_json_limit(spark):
    path = scratch_path(spark, "json")
    batch.export_json(spark.range(500), path, limit=100)
    assert spark.read.schema("id long").json(path).count() == 100


def test_table_is_replaced_and_prunes_by_date(spark, log, november):
    batch.replace_table(log({"date": "2017-11-09"}), "visits", "date")
    batch.replace_table(log({"date": "2017-11-10"}, {"date": "2017-12-01"}), "visits", "date")
    actions = tables.actions_in_range(tables.user_visit_actions(spark, "visits"), november)
    assert actions.count() == 1
    plan = actions._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(1, 4), st.data())
def test_interleaved_bits(spark, k, data):
    values = data.draw(st.lists(st.integers(0, 1023), min_size=k, max_size=k))
    texts = [f"{v:010b}" for v in values]
    want = int("".join(t[i] for i in range(10) for t in texts), 2)
    found = zorder.interleaved([F.lit(v).cast("long") for v in values], 10)
    assert spark.range(1).select(found.alias("z")).first().z == want


def test_z_order_skips_pages_on_every_column(spark, monkeypatch):
    """Against a layout by date, a filter on any other column takes up far fewer rows."""
    monkeypatch.setattr(zorder, "PAGE_ROWS", 250)
    days = "date_format(date_add(DATE'2017-01-01', CAST(id % 60 AS INT)), 'yyyy-MM-dd') AS date"
    # Every combination of day, city and product in an order of its own.
    log = spark.range(60 * 30 * 60).selectExpr(
        "(id * 7919) % 108000 AS id").selectExpr(
        days, "id DIV 60 % 30 AS city_id", "id DIV 1800 AS product_id", "id")
    path = scratch_path(spark, "z")
    with_one_file = log.coalesce(1)
    zorder.write_z_ordered(with_one_file, f"{path}/z", ["date", "city_id", "product_id"])
    plain = with_one_file.sort("date").write.option("parquet.page.row.count.limit", zorder.PAGE_ROWS)
    plain.parquet(f"{path}/plain")
    back = spark.read.parquet(f"{path}/z")
    assert back.count() == 108_000 and back.exceptAll(log).isEmpty()
    for condition in ("date = '2017-01-09'", "city_id = 11", "product_id = 40"):
        rows = {}
        for layout in ("z", "plain"):
            found = []
            frame = spark.read.schema(log.schema).parquet(f"{path}/{layout}").filter(condition)
            rows[layout] = records_read(spark, lambda: found.extend(frame.collect()))
            assert len(found) == log.filter(condition).count()
        assert rows["z"] < 108_000 / 2
        if not condition.startswith("date"):
            assert rows["z"] < rows["plain"] / 2


def test_z_order_of_nothing_and_of_nulls(spark):
    schema = "date string, k long"
    for rows in ([], [(None, None)] * 3, [("2017-11-31", 5), ("2017-11-10", None), (None, -7)]):
        frame = spark.createDataFrame(rows, schema)
        path = scratch_path(spark, "z")
        zorder.write_z_ordered(frame, path, ["date", "k"])
        assert sorted(map(tuple, spark.read.schema(frame.schema).parquet(path).collect()), key=repr) == sorted(rows, key=repr)
    with pytest.raises(ValueError):
        zorder.interleaved([F.lit(1)] * 7)


def test_sources_by_path(spark, rows):
    path = scratch_path(spark, "products")
    rows(schemas.PRODUCT_INFO, {"product_id": 1}).write.parquet(path)
    assert tables.products(spark, path).schema == schemas.PRODUCT_INFO
    assert tables.default_cities(spark).count() == 10


def test_jdbc_options():
    target = JdbcTarget("jdbc:some://host/db", "me", "secret")
    assert target.options("t") == {
        "url": "jdbc:some://host/db",
        "dbtable": "t",
        "user": "me",
        "password": "secret",
        "batchsize": "10000",
        "numPartitions": "10",
    }
    assert "secret" not in repr(target)


def test_stored_report_equals_lazy_report(spark, log, people, november):
    raw = log(
        *[
            {
                "session_id": f"s{i % 7}",
                "page_id": i,
                "click_category_id": i % 4,
                "user_id": 1 + i % 7 % 2,
                "action_time": f"2017-11-10 3:00:{i:02d}",
            }
            for i in range(40)
        ]
    )
    written = {}
    stored = session_report(raw, people, november, "t")
    write_report(stored, lambda df, table: written.update({table: _set(df)}))
    lazy = session_report(raw, people, november, "t", keep=lambda df, name: df)
    assert written == {table: _set(df) for table, df in lazy.items()}
    assert {t: df.schema.names for t, df in stored.items()} == {
        "session_aggr_stat": schemas.SESSION_AGGR_STAT.names,
        "session_random_extract": schemas.SESSION_RANDOM_EXTRACT.names,
        "session_detail": schemas.SESSION_DETAIL.names,
        "top10_category": schemas.TOP10_CATEGORY.names,
        "top10_session": schemas.TOP10_SESSION.names,
    }
    # All seven sessions are drawn and all lead a category: each action is reported twice.
    assert stored["session_detail"].count() == 80
