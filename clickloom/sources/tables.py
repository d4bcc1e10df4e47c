"""Batch sources: the action log and its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom import schemas
from clickloom.functions.datetime import parse_log_time
from clickloom.functions.predicates import date_in
from clickloom.params import TaskParams

# The city dimension (city_id, city_name, area).
CITIES = [
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]


def read_table(spark: SparkSession, name_or_path: str, schema: StructType) -> DataFrame:
    """A catalog table by name, or the parquet files below a path."""
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    return spark.read.schema(schema).parquet(name_or_path)


def user_visit_actions(spark: SparkSession, name_or_path: str) -> DataFrame:
    return read_table(spark, name_or_path, schemas.USER_VISIT_ACTION)


def users(spark: SparkSession, name_or_path: str) -> DataFrame:
    return read_table(spark, name_or_path, schemas.USER_INFO)


def products(spark: SparkSession, name_or_path: str) -> DataFrame:
    return read_table(spark, name_or_path, schemas.PRODUCT_INFO)


def cities(spark: SparkSession, name_or_path: str) -> DataFrame:
    return read_table(spark, name_or_path, schemas.CITY_INFO)


def default_cities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITIES, schemas.CITY_INFO)


def actions_in_range(raw: DataFrame, params: TaskParams) -> DataFrame:
    """The log of the task's days, typed for the operators.

    Adds ``action_ts`` and turns the -1 of an absent category or product into NULL.
    Both are projections above the date filter, so pruning and pushdown still reach the scan.
    """
    return raw.filter(date_in(F.col("date"), params.start_date, params.end_date)).withColumns(
        {
            "action_ts": parse_log_time(F.col("action_time")),
            "click_category_id": F.nullif("click_category_id", F.lit(-1)),
            "click_product_id": F.nullif("click_product_id", F.lit(-1)),
        }
    )


def product_clicks(raw: DataFrame, params: TaskParams) -> DataFrame:
    """City and product of every product click of the task's days."""
    return raw.filter(
        date_in(F.col("date"), params.start_date, params.end_date)
        & F.col("click_product_id").isNotNull()
        & (F.col("click_product_id") != -1)
    ).select("city_id", F.col("click_product_id").alias("product_id"))
