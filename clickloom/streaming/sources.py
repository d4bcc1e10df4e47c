"""Streaming sources. The jobs take any stream with a string column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(group_prefix: str | None, offsets_per_batch: int | None) -> dict[str, str]:
    given = {"groupIdPrefix": group_prefix, "maxOffsetsPerTrigger": offsets_per_batch}
    return {name: str(value) for name, value in given.items() if value is not None}


def kafka_lines(
    spark: SparkSession,
    brokers: str,
    topic: str,
    group_prefix: str | None = None,
    offsets_per_batch: int | None = None,
) -> DataFrame:
    """Message texts of a topic, from its latest offsets.

    Needs Spark's Kafka package on the class path. Offsets are kept in the query's
    checkpoint and are not committed to a group. Every query gets a group of its own, whose
    name begins with ``group_prefix``. ``offsets_per_batch`` bounds a micro-batch, so that a
    backlog is worked off in several.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
    )
    for option, value in kafka_options(group_prefix, offsets_per_batch).items():
        reader = reader.option(option, value)
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def file_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a folder."""
    reader = spark.readStream.format("text").schema("value STRING")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
