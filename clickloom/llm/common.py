"""What several corpus operators share: words in SQL, gapless numbers, grouping by bytes."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.session import materialize

#: A word is a longest run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
_GAPS = r"[\x20\x09-\x0D]+"
#: Stands for a null doc_id inside an operator: before all others.
NULL_ID = -(2**63)


def words(text: Column) -> Column:
    """The words of a text as an array; none for a null text."""
    parts = F.split(F.coalesce(text, F.lit("")), _GAPS)
    return F.filter(parts, lambda word: word != "")


def word_count(text: Column) -> Column:
    """The number of words as a long, without building the array twice."""
    parts = F.split(F.coalesce(text, F.lit("")), _GAPS)
    # Only the first and the last part can be empty.
    return F.transform(
        F.array(parts),
        lambda p: F.size(p)
        - F.when(F.element_at(p, 1) == "", 1).otherwise(0)
        - F.when((F.size(p) > 1) & (F.element_at(p, -1) == ""), 1).otherwise(0),
    )[0].cast("long")


def parted(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, with ``_part`` and ``_row`` from the input partitions.

    ``_part`` groups have the size of an input partition whatever the keys are, so that
    numbering by part never puts a hot key into one task. The numbers are fixed in the
    written table: a retried task cannot renumber them.
    """
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    return materialize(numbered, name).withColumn("_part", F.shiftright("_row", 33))


def offsets(df: DataFrame, keys: list[str], amount: Column) -> DataFrame:
    """For each key and part, what the parts before it hold of ``amount`` in that key."""
    totals = df.groupBy(*keys, "_part").agg(F.sum(amount).alias("_amount"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *keys, "_part", F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_before")
    )


def with_running_amount(
    df: DataFrame, keys: list[str], amount: str, order: list[str], target: str
) -> DataFrame:
    """Adds ``target``: the amount of all earlier rows of the key (0 for its first row).

    ``df`` has ``_part`` (see ``parted``). Rows are ordered by part and then ``order``;
    every window covers one key of one part, and the parts' totals are added to it.
    """
    before = (
        Window.partitionBy(*keys, "_part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = offsets(df, keys, F.col(amount)).alias("o")
    inner = df.withColumn("_inner", F.coalesce(F.sum(amount).over(before), F.lit(0))).alias("d")
    on = F.col("d._part") == F.col("o._part")
    for key in keys:
        on = on & F.col(f"d.{key}").eqNullSafe(F.col(f"o.{key}"))
    columns = [F.col(f"d.{name}") for name in df.columns]
    total = (F.col("d._inner") + F.col("o._before")).cast("long")
    return inner.join(start, on).select(*columns, total.alias(target))


def groups_of(texts: DataFrame, bytes_per_group: int = 4 << 20) -> int:
    """How many groups of about ``bytes_per_group`` the column ``text`` makes."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // bytes_per_group))


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder as Spark names it, and the path in it."""
    scheme, colon, rest = path.partition(":")
    if not colon:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    # Spark's names of the object store's connectors.
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    return fs.FileSystem.from_uri(f"{scheme}:{rest}")
