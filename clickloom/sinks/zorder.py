"""A file layout that prunes on any of several columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 10
# Rows of a page, the least that a filter can skip.
PAGE_ROWS = 2_000


def _number(df: DataFrame, name: str) -> Column:
    """A column as a number in the same order; text must be a date."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.unix_date(F.col(name).try_cast("date")).cast("double")
    return F.col(name).cast("double")


def interleaved(values: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of whole numbers in turn, the highest ones first, as one long."""
    k = len(values)
    if k * bits > 63:
        raise ValueError("more bits than a long has")
    parts = [
        F.shiftleft(F.shiftright(value, i).bitwiseAND(F.lit(1).cast("long")), i * k + k - 1 - j)
        for i in range(bits)
        for j, value in enumerate(values)
    ]
    return reduce(add, parts)


def z_ordered(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` in ranges of the Z-order curve over ``columns``: numbers, or dates as text.

    Every column is scaled to ``bits`` bits between its least and its greatest value, which
    one aggregate finds; NULL and text that is no date count as the least. Neighbours on the
    curve are near each other in all columns, so a range of rows, and each page of it, spans
    a small part of every column. A number for each row lets a range end between equal ones.
    """
    ends = df.agg(
        *[f(_number(df, name)).alias(f"{at}{i}") for i, name in enumerate(columns) for f, at in ((F.min, "low"), (F.max, "high"))]
    ).first()
    top = 2**bits - 1
    scaled = []
    for i, name in enumerate(columns):
        low, high = ends[f"low{i}"], ends[f"high{i}"]
        share = F.lit(0.0) if low is None or low == high else (_number(df, name) - low) / (high - low)
        scaled.append(F.coalesce(F.floor(share * top), F.lit(0)).cast("long"))
    keyed = df.withColumn("_z", interleaved(scaled, bits))
    ranged = keyed.repartitionByRange("_z", F.xxhash64(F.monotonically_increasing_id()))
    return ranged.sortWithinPartitions("_z").drop("_z")


def write_z_ordered(df: DataFrame, path: str, columns: Sequence[str], bits: int = BITS) -> None:
    """Write ``df`` as parquet in Z-order, in place of what is there."""
    writer = z_ordered(df, columns, bits).write.mode("overwrite")
    writer.option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path)
