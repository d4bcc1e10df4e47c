"""Ad clicks: parsing, daily counts, blacklist, running totals, top ads and trend.

Parsing, counts, totals and trend work on a batch and on a stream; the rest on a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.datetime import format_date, format_time, from_epoch_millis

BLACKLIST_THRESHOLD = 100
# A list of this many ids is some tens of megabytes as a broadcast table.
MAX_BROADCAST_USERS = 500_000
# A bitmap takes 4 KB, a listed user some tens of bytes.
BITMAP_USERS = 100
# Milliseconds of the years 1 to 9999; a number outside is no time but a malformed line.
_FIRST_MILLIS, _LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def _fields(lines: DataFrame) -> DataFrame:
    # Exploding the one-element array fixes the split as a column. As a plain expression it
    # would be copied into each condition of a later filter, which doubles the time.
    split = F.explode(F.array(F.split("value", " "))).alias("parts")

    def part(i: int) -> Column:
        return F.get("parts", F.lit(i))

    millis = part(0).try_cast("long")
    in_range = millis.between(_FIRST_MILLIS, _LAST_MILLIS)
    return lines.select(split).select(
        F.when(in_range, from_epoch_millis(millis)).alias("ts"),
        part(1).alias("province"),
        part(2).alias("city"),
        part(3).try_cast("long").alias("user_id"),
        part(4).try_cast("long").alias("ad_id"),
    )


_WELL_FORMED = "ts IS NOT NULL AND user_id IS NOT NULL AND ad_id IS NOT NULL"


def _line_measures() -> list[Column]:
    malformed = ~F.expr(f"coalesce({_WELL_FORMED}, false)")
    return [
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(malformed).alias("malformed_count"),
    ]


def parse_clicks(lines: DataFrame, observed_as: str | None = None) -> DataFrame:
    """``timestamp province city userid adid`` lines to columns; malformed lines are left out.

    With ``observed_as`` Spark reports the counts of ``line_quality`` under that name, for a
    stream in the progress of every batch.
    """
    fields = _fields(lines)
    if observed_as is not None:
        fields = fields.observe(observed_as, *_line_measures())
    return fields.filter(_WELL_FORMED).select(
        format_date(F.col("ts")).alias("date"), "ts", "province", "city", "user_id", "ad_id"
    )


def line_quality(lines: DataFrame) -> DataFrame:
    """One row: how many lines there are and how many of them are malformed."""
    return _fields(lines).agg(*_line_measures())


def user_daily_clicks(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("date", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def blacklisted_users(daily: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users with ``threshold`` clicks on one ad in one day."""
    return daily.filter(F.col("click_count") >= threshold).select("user_id").distinct()


def without_users(clicks: DataFrame, users: DataFrame) -> DataFrame:
    """Rows whose user is not listed. The list may grow without bound, so no broadcast hint."""
    return clicks.join(users.select("user_id"), "user_id", "left_anti")


def counts_without_users(counts: DataFrame, users: DataFrame) -> DataFrame:
    """``without_users`` for clicks that are already combined; ``users`` are distinct.

    An outer join with a test for no match: Catalyst would move an anti join below the
    aggregate and shuffle every click of a hot user.
    """
    listed = users.select("user_id", F.lit(True).alias("listed"))
    return counts.join(listed, "user_id", "left").filter(F.col("listed").isNull()).drop("listed")


def click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks by every key the totals use, so that a hot user or ad is a few rows afterwards."""
    return clicks.groupBy("date", "user_id", "province", "city", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def running_totals(clicks: DataFrame) -> DataFrame:
    """Clicks by day, province, city and ad."""
    return clicks.groupBy("date", "province", "city", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def sum_totals(counts: DataFrame) -> DataFrame:
    """``running_totals`` from ``click_counts``."""
    return counts.groupBy("date", "province", "city", "ad_id").agg(
        F.sum("click_count").alias("click_count")
    )


def totals_without_users(
    clicks: DataFrame, users: DataFrame, broadcast_limit: int = MAX_BROADCAST_USERS
) -> DataFrame:
    """``running_totals`` of the users that are not in ``users``, which are distinct.

    The list is counted first, so it should be stored rows. Up to the limit it is broadcast
    and the clicks are shuffled once. Beyond it the clicks are combined by user and totals
    key before they meet the list.
    """
    if users.limit(broadcast_limit + 1).count() <= broadcast_limit:
        return running_totals(without_users(clicks, F.broadcast(users)))
    return sum_totals(counts_without_users(click_counts(clicks), users))


def province_totals(totals: DataFrame) -> DataFrame:
    return totals.groupBy("date", "province", "ad_id").agg(
        F.sum("click_count").alias("click_count")
    )


def top_ads_by_province(totals: DataFrame, limit: int = 3) -> DataFrame:
    """The most clicked ads of each province and day."""
    rank = Window.partitionBy("date", "province").orderBy(F.desc("click_count"), "ad_id")
    return (
        province_totals(totals)
        .withColumn("place", F.row_number().over(rank))
        .filter(F.col("place") <= limit)
        .select("date", "province", "ad_id", "click_count")
    )


def merged_top_ads(top: DataFrame, grown: DataFrame, limit: int = 3) -> DataFrame:
    """The top ads of each province and day from the last ones and the totals that grew.

    ``top`` has the rows of ``top_ads_by_province`` before, ``grown`` all totals of the ads
    that were clicked since. Clicks are only added, so no other ad can have come up.
    """
    now = province_totals(grown)
    kept = top.join(now.select("date", "province", "ad_id"), ["date", "province", "ad_id"], "left_anti")
    rank = Window.partitionBy("date", "province").orderBy(F.desc("click_count"), "ad_id")
    return (
        kept.unionByName(now)
        .withColumn("place", F.row_number().over(rank))
        .filter(F.col("place") <= limit)
        .select("date", "province", "ad_id", "click_count")
    )


def _minute_rows(counts: DataFrame, *extra: str) -> DataFrame:
    return counts.select(
        *extra,
        format_date(F.col("minute_ts")).alias("date"),
        F.date_format("minute_ts", "HH").alias("hour"),
        F.date_format("minute_ts", "mm").alias("minute"),
        "ad_id",
        "click_count",
    )


def click_trend(clicks: DataFrame) -> DataFrame:
    """Clicks per minute and ad."""
    counts = (
        clicks.groupBy(F.window("ts", "1 minute").alias("w"), "ad_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(F.col("w.start").alias("minute_ts"), "ad_id", "click_count")
    )
    return _minute_rows(counts)


def slot_counts(clicks: DataFrame, slot: str = "10 seconds") -> DataFrame:
    """Clicks per slot of time and ad: date, slot (its start as text), ad_id, click_count."""
    counted = clicks.groupBy(F.window("ts", slot).alias("w"), "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )
    start = F.col("w.start")
    return counted.select(
        format_date(start).alias("date"), format_time(start).alias("slot"), "ad_id", "click_count"
    )


def _slot_ts() -> Column:
    return F.to_timestamp("slot", "yyyy-MM-dd HH:mm:ss")


def minute_counts(slots: DataFrame) -> DataFrame:
    """``click_trend`` from the counts of slots that divide a minute."""
    counts = slots.groupBy(F.date_trunc("minute", _slot_ts()).alias("minute_ts"), "ad_id").agg(
        F.sum("click_count").alias("click_count")
    )
    return _minute_rows(counts)


def sliding_windows(
    slots: DataFrame, length: str = "60 minutes", slide: str = "10 seconds"
) -> DataFrame:
    """The trend as each sliding window shows it: clicks per window, minute and ad.

    Only the counts of slots are copied into the windows. A slot must divide both a minute
    and the slide.
    """
    counts = (
        slots.select(_slot_ts().alias("slot_ts"), "ad_id", "click_count")
        .groupBy(
            F.window("slot_ts", length, slide).alias("w"),
            F.date_trunc("minute", "slot_ts").alias("minute_ts"),
            "ad_id",
        )
        .agg(F.sum("click_count").alias("click_count"))
        .select(F.col("w.end").alias("window_end"), "minute_ts", "ad_id", "click_count")
    )
    return _minute_rows(counts, "window_end")


def sliding_click_trend(
    clicks: DataFrame, length: str = "60 minutes", slide: str = "10 seconds"
) -> DataFrame:
    """``sliding_windows`` of clicks, which are counted per slot first."""
    return sliding_windows(slot_counts(clicks), length, slide)


def window_runs(slots: DataFrame, length: int = 3600, slide: int = 10) -> DataFrame:
    """The sliding trend as runs of windows in which the clicks of a minute and ad are equal.

    The windows are ``length`` seconds long and end every ``slide`` seconds; both are
    multiples of the slots, and the length is one of the slide. What a window shows of a minute
    changes only where one of the minute's slots comes in or goes out. So each slot is two
    changes instead of a copy for each of its windows, and their prefix sums over the few
    changes of a minute and ad are the counts. A row stands for the windows that end from
    ``first_end`` to ``last_end``.
    """
    if length % slide:
        raise ValueError("the length must be a multiple of the slide")
    second = F.unix_timestamp(_slot_ts())
    first = second - second % slide + slide
    changes = slots.select(
        F.date_trunc("minute", _slot_ts()).alias("minute_ts"),
        "ad_id",
        F.inline(
            F.array(
                F.struct(first.alias("at"), F.col("click_count").alias("change")),
                F.struct((first + length).alias("at"), (-F.col("click_count")).alias("change")),
            )
        ),
    )
    changes = changes.groupBy("minute_ts", "ad_id", "at").agg(F.sum("change").alias("change"))
    in_order = Window.partitionBy("minute_ts", "ad_id").orderBy("at")
    runs = changes.filter("change <> 0").select(
        "minute_ts",
        "ad_id",
        F.timestamp_seconds("at").alias("first_end"),
        F.timestamp_seconds(F.lead("at").over(in_order) - slide).alias("last_end"),
        F.sum("change").over(in_order).alias("click_count"),
    )
    return _minute_rows(runs.filter("click_count > 0"), "first_end", "last_end")


def shown_in_window(runs: DataFrame, end: Column) -> DataFrame:
    """What one window of ``window_runs`` shows: clicks per minute and ad."""
    inside = end.between(F.col("first_end"), F.col("last_end"))
    return runs.filter(inside).drop("first_end", "last_end")


def user_bitmap(users: DataFrame) -> DataFrame:
    """``users`` as (bucket, bitmap): a bit for each of the 32,768 ids of a bucket.

    Ids of any sign and size have a bit of their own. Bits are set in the map tasks, and
    only bitmaps are shuffled. A bucket is 4 KB, whatever number of its ids is listed.
    """
    return users.groupBy(F.bitmap_bucket_number("user_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("bitmap")
    )


def without_listed(rows: DataFrame, users: DataFrame) -> DataFrame:
    """``without_users`` for combined rows and stored distinct ``users``, by the smaller list.

    Where ids are dense the list is ``user_bitmap``; where a bitmap would hold fewer than
    BITMAP_USERS of them on average it is one row per user.
    """
    bucket = F.bitmap_bucket_number("user_id")
    found = users.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(bucket).alias("buckets")).first()
    if found.n >= BITMAP_USERS * found.buckets:
        return without_bitmap(rows, user_bitmap(users))
    return counts_without_users(rows, users)


def without_bitmap(rows: DataFrame, bitmap: DataFrame) -> DataFrame:
    """Rows whose user has no bit in ``user_bitmap``; a row without user stays.

    An outer join by bucket and a test of the bit: below an aggregate the rows stay combined.
    """
    place = F.bitmap_bit_position("user_id")
    byte = F.substring("bitmap", (place / 8).cast("int") + 1, F.lit(1))
    listed = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1
    bucket = F.bitmap_bucket_number("user_id").alias("bucket")
    joined = rows.select("*", bucket).join(bitmap, "bucket", "left")
    return joined.filter(F.col("bitmap").isNull() | ~listed).select(*rows.columns)
