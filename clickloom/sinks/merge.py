"""What a stored table looks like after a batch: one function per kind of update."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def insert_new(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep stored rows; add rows of the batch whose key is not stored yet."""
    added = batch.dropDuplicates(list(keys)).join(stored.select(*keys), list(keys), "left_anti")
    return stored.unionByName(added)


def add_counts(stored: DataFrame, batch: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Insert new keys and add the batch's value to the stored one of known keys."""
    both = stored.select(*keys, value).unionByName(batch.select(*keys, value))
    return both.groupBy(*keys).agg(F.sum(value).alias(value))


def overwrite_rows(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert new keys and replace the stored row of known keys.

    ``keys`` identify a row of the batch. To replace whole groups, give the group's
    columns: every stored row of a group in the batch makes way.
    """
    touched = batch.select(*keys).distinct()
    return stored.join(touched, list(keys), "left_anti").unionByName(batch)
