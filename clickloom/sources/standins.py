"""The shop's tables derived from the generic test tables.

``events`` plays the action log and the ad clicks, ``customer`` with ``nation`` the users,
``part`` the products.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Search words of the stand-in log. Some lie inside others, so that matching by substring
# would show.
WORDS = [
    "tea",
    "green tea",
    "iced green tea",
    "lamp",
    "desk lamp",
    "coat",
    "rain coat",
    "bicycle",
    "helmet",
    "chair",
    "garden chair",
    "rope",
    "tent",
]
HOURS = 24
YOUNGEST, AGES = 18, 50


# Given, so that no job has to look into a file for it.
_SCHEMAS = {
    "events": "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, "
    "props STRING",
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "part": "p_partkey LONG, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _props_k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def _when(event_type: str, value: Column) -> Column:
    return F.when(F.col("event_type") == event_type, value)


def user_visit_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, event, user = F.col("k"), F.col("event_id"), F.col("user_id")
    offset = (event * 37) % 3540
    clock = F.concat_ws(
        ":",
        (user * 7) % HOURS,
        F.lpad(F.floor(offset / 60).cast("string"), 2, "0"),
        F.lpad((offset % 60).cast("string"), 2, "0"),
    )
    words = F.array(*[F.lit(word) for word in WORDS])
    return (
        read(spark, sf_dir, "events")
        .withColumn("k", _props_k())
        .withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
        .select(
            "date",
            "user_id",
            F.concat_ws("_", user, F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            (k % 10).alias("page_id"),
            F.concat_ws(" ", "date", clock).alias("action_time"),
            _when("view", F.get(words, (event % len(WORDS)).cast("int"))).alias("search_keyword"),
            F.coalesce(_when("click", (event * 7 + k) % 20), F.lit(-1)).alias("click_category_id"),
            F.coalesce(_when("click", k), F.lit(-1)).alias("click_product_id"),
            _when("purchase", F.concat_ws(",", k % 20, (k + 7) % 20)).alias("order_category_ids"),
            _when("purchase", F.concat_ws(",", k, (k + 31) % 100)).alias("order_product_ids"),
            _when("signup", (k % 20).cast("string")).alias("pay_category_ids"),
            _when("signup", k.cast("string")).alias("pay_product_ids"),
            (event % 10).alias("city_id"),
        )
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers = read(spark, sf_dir, "customer")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("shopper-"), F.col("c_custkey")).alias("username"),
        F.col("c_name").alias("name"),
        (YOUNGEST + F.col("c_custkey") % AGES).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.concat(F.lit('{"product_status": '), F.col("p_partkey") % 2, F.lit("}"))
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        status.alias("extend_info"),
    )


def ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad click lines in the log format, as ``value``."""
    return read(spark, sf_dir, "events").select(
        F.concat_ws(
            " ",
            F.unix_millis(F.col("ts").cast("timestamp")),
            F.col("user_id") % 10,
            F.col("event_id") % 10,
            F.col("user_id"),
            _props_k() % 30,
        ).alias("value")
    )
