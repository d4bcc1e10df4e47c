"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "clickloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings every job here relies on.

    AQE coalesces small shuffle partitions and splits skewed join partitions, so on a
    cluster ``shuffle_partitions`` should be an upper bound (for 100 TB some tens of
    thousands). Streaming state is kept in RocksDB, off the JVM heap.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        # Longer lists are pushed to the pages of a file as one range.
        .config("spark.sql.parquet.pushdown.inFilterThreshold", "1000")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediate tables, which every executor must reach.

    The one the cluster names in ``spark.checkpoint.dir``; where that is unset, a folder
    of the warehouse, which executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    For a frame that feeds several outputs: unlike a cache, the written table survives
    the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
