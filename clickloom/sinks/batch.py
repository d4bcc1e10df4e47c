"""Batch sinks: JDBC and file append, managed table, CSV and JSON export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.schemas import AD_RECORD_NAMES
from clickloom.sources.jdbc import JdbcTarget


def append_jdbc(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Append a result. Spark writes it in batches over at most ``max_connections``."""
    df.write.format("jdbc").options(**target.options(table)).mode("append").save()


def replace_jdbc(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Replace the rows of a table and keep its definition and indexes."""
    writer = df.write.format("jdbc").options(**target.options(table)).option("truncate", "true")
    writer.mode("overwrite").save()


def append_files(df: DataFrame, folder: str, table: str) -> None:
    """Append a result to the parquet table of that name below ``folder``."""
    df.write.mode("append").parquet(f"{folder.rstrip('/')}/{table}")


def jdbc_publisher(target: JdbcTarget) -> Callable[[str, DataFrame, int], None]:
    """A publisher for the ad streams that appends every changed row with its batch id.

    The rows hold totals, not increments, so the row of the highest batch is the current
    one and a replayed batch does no harm.
    """

    def publish(table: str, rows: DataFrame, batch_id: int) -> None:
        stamped = rows.withColumnsRenamed(AD_RECORD_NAMES).withColumn("batchid", F.lit(batch_id))
        append_jdbc(stamped, target, table)

    return publish


def replace_table(
    df: DataFrame,
    name: str,
    partition_by: str | None = None,
    bucket_by: tuple[str, int] | None = None,
    path: str | None = None,
) -> None:
    """Replace a catalog table.

    Partition the action log by ``date``: a task then reads its own days only. Rows are
    first sent to their partition, so a day is not one small file per task; AQE splits a
    large day again.

    ``bucket_by``, for example ``("session_id", 4096)``, stores rows by key instead: rollups,
    windows and joins on the key then need no shuffle. A key with a large share of the rows
    makes one large bucket, so leave it out where such keys are expected.
    """
    if bucket_by:
        column, buckets = bucket_by
        writer = df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column)
    elif partition_by:
        writer = df.hint("rebalance", partition_by).write
    else:
        writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if path:
        writer = writer.option("path", path)
    writer.mode("overwrite").saveAsTable(name)


def export_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """Comma-separated text; values with a comma or quote are quoted."""
    df.write.mode("overwrite").option("header", header).option("escape", '"').csv(path)


def export_json(df: DataFrame, path: str, limit: int | None = None) -> None:
    """One JSON object per line, optionally of the first ``limit`` rows only."""
    chosen = df if limit is None else df.limit(limit)
    chosen.write.mode("overwrite").json(path)
