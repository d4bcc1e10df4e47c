from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickloom import TaskParams, build_session, schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        4,
        {
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.debug.maxToStringFields": "1000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """Rows of a schema from dicts; a column that is not given is NULL."""

    def make(schema, *records):
        data = [tuple(record.get(name) for name in schema.names) for record in records]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture(scope="session")
def log(rows):
    """An action log from dicts with short defaults."""

    def make(*records):
        defaults = {
            "date": "2017-11-10",
            "user_id": 1,
            "session_id": "s",
            "page_id": 1,
            "action_time": "2017-11-10 3:00:00",
            "click_category_id": -1,
            "click_product_id": -1,
            "city_id": 0,
        }
        return rows(schemas.USER_VISIT_ACTION, *[{**defaults, **record} for record in records])

    return make


@pytest.fixture(scope="session")
def people(rows):
    """Users 1 and 2."""
    return rows(
        schemas.USER_INFO,
        {"user_id": 1, "age": 20, "professional": "it", "city": "rome", "sex": "male"},
        {"user_id": 2, "age": 50, "professional": "art", "city": "-1", "sex": "female"},
    )


@pytest.fixture(scope="session")
def november():
    return TaskParams("2017-11-10", "2017-11-31")


def records_read(spark, action):
    """How many rows of files the jobs of ``action`` took up."""
    scala = spark.sparkContext._jsc.sc()
    gateway = spark.sparkContext._gateway

    def total():
        scala.listenerBus().waitUntilEmpty()
        quantiles = gateway.new_array(gateway.jvm.double, 0)
        stages = scala.statusStore().stageList(
            None, False, False, quantiles, gateway.jvm.java.util.ArrayList()
        )
        return sum(stages.apply(i).inputRecords() for i in range(stages.size()))

    before = total()
    action()
    return total() - before
