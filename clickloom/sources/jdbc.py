"""JDBC connection settings and the full-table read."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """One database. ``password`` stays out of the repr and so out of logs."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    batch_size: int = 10_000
    max_connections: int = 10

    def options(self, table: str) -> dict[str, str]:
        given = {
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.max_connections),
        }
        return {key: value for key, value in given.items() if value is not None}


def read_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
) -> DataFrame:
    """The whole table, in one task, or in ``max_connections`` ranges of a column.

    ``lower`` and ``upper`` must be about the least and the greatest value of
    ``partition_column``; rows outside are read as well.
    """
    options = target.options(table) | range_options(partition_column, lower, upper)
    return spark.read.format("jdbc").options(**options).load()


def range_options(column: str | None, lower: int | None, upper: int | None) -> dict[str, str]:
    if column is None:
        return {}
    if lower is None or upper is None or lower >= upper:
        raise ValueError("partition_column needs lower < upper, else one task reads all")
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper)}
