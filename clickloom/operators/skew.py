"""Finding the few keys that hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most this many keys can each hold 1/MAX_HEAVY_KEYS of the rows, whatever the data.
MAX_HEAVY_KEYS = 100_000
# Below this a group sorts comfortably inside one task.
MIN_HEAVY_ROWS = 1_000_000


def heavy_keys(df: DataFrame, key: str, min_rows: int = MIN_HEAVY_ROWS) -> DataFrame:
    """Keys with at least ``min_rows`` rows that also hold 1/MAX_HEAVY_KEYS of all rows.

    The counts are exact and combined before the shuffle. The share bounds the result at
    MAX_HEAVY_KEYS rows, so it may be broadcast. A group that is kept out by the share
    alone is below total/MAX_HEAVY_KEYS rows.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.filter(
        (F.col("n") >= min_rows) & (F.col("n") * MAX_HEAVY_KEYS >= total)
    ).select(key)
