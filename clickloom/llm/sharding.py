"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import parted, with_running_amount


def _score(key: Column, shard: Column, weight: Column) -> Column:
    """Larger wins; the winner is shard i with probability weight i / all weights."""
    bits = F.shiftrightunsigned(F.xxhash64(key, shard), 11).cast("double")
    unit = (bits + 0.5) / F.lit(float(2**53))
    return -weight / F.log(unit)


def rendezvous_shard(key: Column, weights: Sequence[float], extra: float | None = None) -> Column:
    """The shard of a key: the one whose score for the key is the highest.

    A score depends on the key, the shard's number and its weight alone. So a further
    shard only takes the keys on which it wins, and a removed one only frees its own.
    Shards of weight 0 or less get nothing. A null key is a key like any other. With
    ``extra``, the result is a struct (shard, grown_shard): the shard now, and the one
    with another shard of that weight at the end.
    """
    if not any(weight > 0 for weight in weights):
        raise ValueError("at least one shard needs a weight above 0")
    shards = F.array(
        *[
            F.struct(F.lit(i).alias("shard"), F.lit(float(weight)).alias("weight"))
            for i, weight in enumerate(weights)
            if weight > 0
        ]
    )
    scores = F.transform(
        shards,
        lambda s: F.struct(
            _score(key, s["shard"], s["weight"]).alias("score"), (-s["shard"]).alias("order")
        ),
    )
    best = F.array_max(scores)
    if extra is None:
        return -best["order"]
    new = len(weights)

    def grown(top: Column) -> Column:
        wins = _score(key, F.lit(new), F.lit(float(extra))) > top["score"]
        return F.struct(
            (-top["order"]).alias("shard"),
            F.when(wins, F.lit(new)).otherwise(-top["order"]).alias("grown_shard"),
        )

    return F.transform(F.array(best), grown)[0]


def shard_records(
    df: DataFrame, key: str, weights: Sequence[float], extra: float = 1.0
) -> DataFrame:
    """Adds ``shard``, ``slot`` (gapless from 0 in each shard) and ``grown_shard``.

    Rows with equal keys, also null ones, meet in one shard. Slots are numbered by input
    partition and the counts of the partitions before, so no task sees a whole shard;
    which slot a row gets depends on the row order of the input, its shard does not.
    The input may have any columns but those added and ``_row``, ``_part``, ``_one``.
    An empty input gives an empty result.
    """
    placed = df.withColumn("_place", rendezvous_shard(F.col(key), weights, extra))
    placed = placed.withColumn("shard", F.col("_place.shard")).withColumn(
        "grown_shard", F.col("_place.grown_shard")
    )
    rows = parted(placed.drop("_place"), "shards").withColumn("_one", F.lit(1))
    numbered = with_running_amount(rows, ["shard"], "_one", ["_row"], "slot")
    return numbered.drop("_row", "_part", "_one")


def sharded_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """The documents over equal shards by doc_id; a null text has no bytes and CRC 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return shard_records(sized, "doc_id", [1.0] * shards).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
