"""Keyed result tables fed by micro-batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# So many values of a column are listed as constants, which prune folders and pages.
MAX_LISTED = 1_000
# Partitions for batches; a batch's slot is taken again after this many.
SLOTS = 256
# The slot of the rows that ``fold`` put together.
FOLDED = -1
# Rows a reader must take up to find one key of a folded partition.
PAGE_ROWS = 1_000
MODES = ("insert", "sum", "latest", "replace_group")


class BatchLog:
    """A parquet table that micro-batches add to, merged by one aggregate when it is read.

    It is partitioned by batch slot (the batch number modulo SLOTS) and, above it, by a
    ``segment`` column (the date). A batch replaces the partitions of its slot by dynamic
    partition overwrite: it writes its own rows only, whatever the table has grown to, and a
    replayed batch is stored once. ``fold`` puts the batches of each date that changed
    into one partition, sorted by ``lookup``, in the same way. Its rows carry the last batch
    they hold, and older ones in the slots no longer count, so nothing is ever deleted, and
    a fold that was cut off leaves each date as it was or folded. The modes:

    * ``insert``: a key is stored once;
    * ``sum``: values of a key add up;
    * ``latest``: a key's value is that of its last batch;
    * ``replace_group``: of a group (``keys``), only the rows of its last batch count.
    """

    def __init__(
        self,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        mode: str,
        value: str | None = None,
        segment: str | None = None,
        lookup: str | None = None,
    ):
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}")
        for name in (segment, lookup):
            if name is not None and name not in keys:
                raise ValueError("the segment and the lookup column must be keys")
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.mode = mode
        self.value = value
        self.lookup = lookup
        self.segments = [segment] if segment else []
        self.columns = list(schema.names)
        stored = T.StructType(list(schema.fields))
        self._stored = stored.add("batch_id", T.LongType()).add("batch_slot", T.IntegerType())
        self._order = [*self.segments, "batch_slot", *([lookup] if lookup else [])]
        # The last batch this process has folded.
        self.folded_upto: int | None = None

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Store the rows of one batch, in place of an earlier attempt at it."""
        self._overwrite(
            rows.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn(
                "batch_slot", F.lit(batch_id % SLOTS)
            )
        )

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The table as of batch ``upto`` (inclusive); as of the last one when None."""
        return self._merge(self._rows(spark, upto)).select(*self.columns)

    def written(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows one batch stored."""
        own = (F.col("batch_slot") == batch_id % SLOTS) & (F.col("batch_id") == batch_id)
        return self._all(spark).filter(own).select(*self.columns)

    def changed(
        self, spark: SparkSession, batch_id: int, listed: dict[str, list] | None = None
    ) -> DataFrame:
        """The table's rows, as of a batch, for the keys that batch stored."""
        written = self.written(spark, batch_id)
        return self.matching(spark, batch_id, written, self.keys, listed)

    def matching(
        self,
        spark: SparkSession,
        upto: int,
        reference: DataFrame,
        columns: Sequence[str],
        listed: dict[str, list] | None = None,
    ) -> DataFrame:
        """The table's rows, as of a batch, whose ``columns`` (keys) occur in ``reference``.

        ``listed`` has all values of some columns in ``reference``, as ``listed_values`` gives
        them, which is asked if it is None: dates prune the folders to read, lookup values the
        pages of folded partitions. The join is exact in any case.
        """
        wanted = reference.select(*columns).distinct()
        pruning = [name for name in (*self.segments, self.lookup) if name in columns]
        if listed is None:
            listed = listed_values(reference, pruning)
        rows = _pruned(self.read(spark, upto), listed, pruning)
        return rows.join(wanted, list(columns), "left_semi").select(*self.columns)

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Put the rows as of batch ``upto`` of each date that changed since into one partition.

        To be called before the next batch, at least every SLOTS // 2 of them; the table can
        then no longer be read as of batches before ``upto``. A fold that was cut off may be
        called again.
        """
        rows = self._rows(spark, upto)
        fresh = rows.filter(F.col("batch_slot") != FOLDED)
        if not fresh.isEmpty():
            rows = _pruned(rows, listed_values(fresh, self.segments), self.segments)
            for name in self.segments:
                rows = rows.join(fresh.select(name).distinct(), name, "left_semi")
            merged = (
                self._merge(rows)
                .withColumn("batch_id", F.lit(upto).cast("long"))
                .withColumn("batch_slot", F.lit(FOLDED))
            )
            self._overwrite(merged.repartitionByRange(*self._order))
        self.folded_upto = upto

    def _overwrite(self, rows: DataFrame) -> None:
        rows = rows.select(*self._stored.names).sortWithinPartitions(*self._order)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer = writer.option("parquet.page.row.count.limit", PAGE_ROWS)
        writer.partitionBy(*self.segments, "batch_slot").parquet(self.path)

    def _merge(self, rows: DataFrame) -> DataFrame:
        grouped = rows.groupBy(*self.keys)
        last = F.max("batch_id").alias("batch_id")
        if self.mode == "insert":
            return grouped.agg(F.min("batch_id").alias("batch_id"))
        if self.mode == "sum":
            return grouped.agg(F.sum(self.value).alias(self.value), last)
        if self.mode == "latest":
            newest = F.max_by(self.value, "batch_id").alias(self.value)
            return grouped.agg(newest, last)
        return rows.join(grouped.agg(last), [*self.keys, "batch_id"], "left_semi")

    def _all(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(self._stored).parquet(self.path)
        except AnalysisException as error:  # nothing is stored yet
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self._stored)

    def _rows(self, spark: SparkSession, upto: int | None) -> DataFrame:
        """The stored rows that make up the table as of a batch."""
        rows = self._all(spark)
        is_folded = F.col("batch_slot") == FOLDED
        if upto is not None:
            rows = rows.filter(F.col("batch_id") <= upto)
            if self.folded_upto is not None:
                # Within the job that folds: only the slots taken since have to be looked at.
                slots = {n % SLOTS for n in range(self.folded_upto + 1, upto + 1)}
                rows = rows.filter(F.col("batch_slot").isin(FOLDED, *slots))
                return rows.filter(is_folded | (F.col("batch_id") > self.folded_upto))
        folded = rows.filter(is_folded)
        last = F.max("batch_id").alias("folded_upto")
        if self.segments:
            rows = rows.join(folded.groupBy(*self.segments).agg(last), self.segments, "left")
        else:
            rows = rows.withColumn("folded_upto", folded.agg(last).scalar())
        newer = F.col("batch_id") > F.coalesce("folded_upto", F.lit(-1))
        return rows.filter(is_folded | newer).select(*self._stored.names)


def listed_values(rows: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """For each of the columns that has at most MAX_LISTED values in ``rows``, the values.

    One query for all columns; no more than MAX_LISTED + 1 values of a column reach the driver.
    """
    if not columns:
        return {}
    entry = [
        F.struct(F.lit(name).alias("name"), F.col(name).cast("string").alias("value"))
        for name in columns
    ]
    place = F.row_number().over(Window.partitionBy("name").orderBy("value"))
    first = rows.select(F.inline(F.array(*entry))).distinct().withColumn("place", place)
    found: dict[str, list] = {name: [] for name in columns}
    for row in first.filter(F.col("place") <= MAX_LISTED + 1).collect():
        found[row["name"]].append(row["value"])
    return {name: values for name, values in found.items() if len(values) <= MAX_LISTED}


def _pruned(rows: DataFrame, listed: dict[str, list], columns: Sequence[str]) -> DataFrame:
    """``rows`` cut to the listed values of the columns."""
    for name in columns:
        if name in listed:
            kind = rows.schema[name].dataType
            rows = rows.filter(F.col(name).isin(*[F.lit(v).cast(kind) for v in listed[name]]))
    return rows
