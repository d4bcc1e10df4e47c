"""General keyed counter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by_key(df: DataFrame, key: str) -> DataFrame:
    """How often each value of ``key`` occurs, as ``(key, count)``."""
    return df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("count"))
