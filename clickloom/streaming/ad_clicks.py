"""Real-time ad statistics: blacklist, running totals, top ads per province, click trend."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom import schemas
from clickloom.operators import ads
from clickloom.sinks.batch_log import SLOTS, BatchLog, listed_values

# Called after a batch is stored in a table: table name, the rows it changed, batch id.
Publisher = Callable[[str, DataFrame, int], None]


@dataclass(frozen=True)
class AdSettings:
    threshold: int = ads.BLACKLIST_THRESHOLD
    top: int = 3
    trigger: str = "5 seconds"
    # Fold the stored batches after this many.
    compact_every: int = 100
    # Deal the lines of a batch over so many partitions; None leaves them as the source has them.
    source_partitions: int | None = None

    def __post_init__(self):
        if not 1 <= self.compact_every <= SLOTS // 2:
            raise ValueError(f"compact_every must be from 1 to {SLOTS // 2}")


class AdStore:
    """The stored result tables below one folder, and the 10-second slots of the trend.

    ``batches`` holds the combined clicks of the last batches, for the tables made of them.
    """

    def __init__(self, path: str):
        self.batches = BatchLog(
            f"{path}/ad_batch", schemas.AD_BATCH, schemas.AD_BATCH.names[:-1], "sum", "click_count"
        )
        self.blacklist = BatchLog(
            f"{path}/ad_blacklist", schemas.AD_BLACKLIST, ["user_id"], "insert", lookup="user_id"
        )
        self.user_clicks = BatchLog(
            f"{path}/ad_user_click_count",
            schemas.AD_USER_CLICK_COUNT,
            ["date", "user_id", "ad_id"],
            "sum",
            "click_count",
            segment="date",
            lookup="user_id",
        )
        self.totals = BatchLog(
            f"{path}/ad_stat",
            schemas.AD_STAT,
            ["date", "province", "city", "ad_id"],
            "sum",
            "click_count",
            segment="date",
            lookup="ad_id",
        )
        self.province_top = BatchLog(
            f"{path}/ad_province_top3",
            schemas.AD_PROVINCE_TOP3,
            ["date", "province"],
            "replace_group",
            segment="date",
            lookup="province",
        )
        self.slots = BatchLog(
            f"{path}/ad_click_slot",
            schemas.AD_CLICK_SLOT,
            ["date", "slot", "ad_id"],
            "sum",
            "click_count",
            segment="date",
        )
        self.trend = BatchLog(
            f"{path}/ad_click_trend",
            schemas.AD_CLICK_TREND,
            ["date", "hour", "minute", "ad_id"],
            "sum",
            "click_count",
            segment="date",
        )


def trend_runs(
    spark: SparkSession, store: AdStore, length: int = 3600, slide: int = 10
) -> DataFrame:
    """The stored trend as runs of windows; see ``ads.window_runs``. Made when it is read."""
    return ads.window_runs(store.slots.read(spark), length, slide)


def sliding_trend(
    spark: SparkSession, store: AdStore, length: str = "60 minutes", slide: str = "10 seconds"
) -> DataFrame:
    """The stored trend as sliding windows show it, made when it is read."""
    return ads.sliding_windows(store.slots.read(spark), length, slide)


def _save(
    name: str, log: BatchLog, rows: DataFrame, batch_id: int, publish: Publisher | None
) -> None:
    log.write(rows, batch_id)
    if publish is not None:
        publish(name, log.changed(rows.sparkSession, batch_id), batch_id)


def _fold(
    logs: Sequence[BatchLog], spark: SparkSession, batch_id: int, settings: AdSettings
) -> None:
    """Fold what was stored before this batch: in the first batch of a run and now and then."""
    for log in logs:
        if log.folded_upto is None or batch_id % settings.compact_every == 0:
            log.fold(spark, batch_id - 1)


def apply_batch(
    clicks: DataFrame,
    batch_id: int,
    store: AdStore,
    settings: AdSettings,
    publish: Publisher | None = None,
) -> None:
    """Add the clicks of one micro-batch to the stored tables.

    The clicks are combined once and stored; all tables are made of these counts. Users already
    blacklisted before this batch are left out; users who reach the threshold in it are
    blacklisted from the next one on. Every table adds up over batches, so a click counts
    however late it comes, and no state is kept beside the tables. Everything read is as of
    the batch before or as of this batch, so a replay writes the same rows again.

    Counts only grow, so the new top ads of a province are among the old ones and the ads
    of this batch. Of the totals, only the rows of those ads are looked up.
    """
    spark = clicks.sparkSession
    logs = (store.blacklist, store.user_clicks, store.totals, store.province_top)
    _fold(logs, spark, batch_id, settings)
    banned = store.blacklist.read(spark, batch_id - 1)
    kept = ads.without_listed(ads.click_counts(clicks), banned)
    store.batches.write(kept, batch_id)
    counts = store.batches.written(spark, batch_id)
    # Asked once for all tables.
    listed = listed_values(counts, ["date", "user_id", "ad_id", "province"])
    by_user = counts.groupBy("date", "user_id", "ad_id").agg(
        F.sum("click_count").alias("click_count")
    )
    _save("ad_user_click_count", store.user_clicks, by_user, batch_id, publish)
    grown = store.user_clicks.changed(spark, batch_id, listed)
    crossed = ads.blacklisted_users(grown, settings.threshold)
    _save("ad_blacklist", store.blacklist, crossed, batch_id, publish)
    _save("ad_stat", store.totals, ads.sum_totals(counts), batch_id, publish)
    written = store.totals.written(spark, batch_id)
    groups, ads_of_groups = ["date", "province"], ["date", "province", "ad_id"]
    grown = store.totals.matching(spark, batch_id, written, ads_of_groups, listed)
    before = store.province_top.matching(spark, batch_id - 1, written, groups, listed)
    top = ads.merged_top_ads(before, grown, settings.top)
    _save("ad_province_top3", store.province_top, top, batch_id, publish)


def start_ad_stats(
    lines: DataFrame,
    store: AdStore,
    checkpoint: str,
    settings: AdSettings = AdSettings(),
    publish: Publisher | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start blacklist, user counts, running totals and top ads as one query.

    The numbers of lines and of malformed lines are reported as the observation ``ad_lines``.
    ``available_now`` works through what has arrived and stops.
    """
    writer = (
        ads.parse_clicks(_dealt(lines, settings), observed_as="ad_lines")
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, n: apply_batch(batch, n, store, settings, publish))
    )
    return _trigger(writer, settings, available_now).start()


def start_click_trend(
    lines: DataFrame,
    store: AdStore,
    checkpoint: str,
    settings: AdSettings = AdSettings(),
    publish: Publisher | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the per-minute trend. It reads every click, also of blacklisted users.

    The minutes of a batch are added to the stored ones, so late clicks count as well. A
    batch is read once, for its slots; its minutes are sums of the slots it stored.
    """

    def save(clicks: DataFrame, batch_id: int) -> None:
        spark = clicks.sparkSession
        _fold([store.trend, store.slots], spark, batch_id, settings)
        _save("ad_click_slot", store.slots, ads.slot_counts(clicks), batch_id, None)
        minutes = ads.minute_counts(store.slots.written(spark, batch_id))
        _save("ad_click_trend", store.trend, minutes, batch_id, publish)

    writer = (
        ads.parse_clicks(_dealt(lines, settings))
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(save)
    )
    return _trigger(writer, settings, available_now).start()


def start_running_totals(
    lines: DataFrame,
    store: AdStore | None,
    checkpoint: str,
    settings: AdSettings = AdSettings(),
    publish: Publisher | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the running totals of all clicks as state that Spark keeps.

    A batch costs as much as its keys: their totals are looked up in the state store and
    what changed is published. ``state_totals`` reads the state back. ``store`` is not used.
    """

    def save(rows: DataFrame, batch_id: int) -> None:
        if publish is not None:
            publish("ad_stat", rows, batch_id)
        else:
            rows.write.format("noop").mode("overwrite").save()

    totals = ads.running_totals(ads.parse_clicks(_dealt(lines, settings)))
    writer = totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return _trigger(writer.foreachBatch(save), settings, available_now).start()


def state_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The totals that ``start_running_totals`` holds as of its last batch, to audit results by."""
    state = spark.read.format("statestore").load(checkpoint)
    count = state.schema["value"].dataType.names[0]
    return state.select("key.*", F.col(f"value.{count}").alias("click_count")).toDF(
        *schemas.AD_STAT.names
    )


def _dealt(lines: DataFrame, settings: AdSettings) -> DataFrame:
    if settings.source_partitions is None:
        return lines
    return lines.repartition(settings.source_partitions)


def _trigger(writer, settings: AdSettings, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=settings.trigger)
