"""Every operator as a query over a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import datetime as dt
from clickloom.functions import text
from clickloom.functions.sql import register_sql_functions
from clickloom.operators import (
    ads,
    categories,
    coded_sets,
    counters,
    daily,
    pages,
    products,
    sampling,
    sessions,
)
from clickloom.params import TaskParams
from clickloom.plans import reports
from clickloom.session import materialize, scratch_path
from clickloom.sinks import batch as batch_sinks
from clickloom.sinks import merge, zorder
from clickloom.sources import standins
from clickloom.sources.tables import actions_in_range, default_cities, product_clicks
from clickloom.streaming.ad_clicks import (
    AdSettings,
    AdStore,
    sliding_trend,
    start_ad_stats,
    start_click_trend,
    start_running_totals,
    state_totals,
    trend_runs,
)
from clickloom.streaming.sources import file_lines

Query = Callable[[SparkSession, str], DataFrame]

# The end date is not a day of the calendar on purpose: dates compare as text.
DAYS = {"start_date": "2024-01-01", "end_date": "2024-02-31"}
FLOW = (1, 2, 3, 4, 5, 6, 7)
ANYONE = TaskParams(**DAYS)
TASK = TaskParams(**DAYS, start_age=20, end_age=50, target_page_flow=FLOW)
PEOPLE = TaskParams(
    **DAYS,
    start_age=10,
    end_age=55,
    professionals=("BUILDING", "MACHINERY", "HOUSEHOLD"),
    cities=("NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8", "NATION_13", "NATION_19"),
    sex="male",
)
INTERESTS = TaskParams(**DAYS, keywords=("tea", "tent"), category_ids=("1", "3", "11"))
TASK_ID = "task-1"
LATE_DAY = "2024-01-12"
# Fewer sessions than the log has days.
FEW = 12
# The stand-in clicks never reach 100 per user, ad and day.
THRESHOLD = 3
NOON = "2024-01-15 12:00:00"
# Days on which the parts of the ad log start to arrive.
PART_STARTS = ("", "2024-01-11", "2024-01-21")


def _actions(spark: SparkSession, sf: str, params: TaskParams = TASK) -> DataFrame:
    return actions_in_range(standins.user_visit_actions(spark, sf), params)


def _sessions(spark: SparkSession, sf: str, params: TaskParams = TASK) -> DataFrame:
    return sessions.filtered_sessions(_actions(spark, sf), standins.users(spark, sf), params)


def _per_session(spark: SparkSession, sf: str) -> DataFrame:
    return categories.category_session_counts(_actions(spark, sf), _sessions(spark, sf))


def _steps(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_steps(_actions(spark, sf))


def _clicks(spark: SparkSession, sf: str) -> DataFrame:
    return ads.parse_clicks(standins.ad_lines(spark, sf))


# Sources

def action_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _actions(spark, sf).select(
        "date",
        "user_id",
        "session_id",
        "page_id",
        dt.format_time(F.col("action_ts")).alias("action_time"),
        "search_keyword",
        "click_category_id",
        "click_product_id",
        "order_category_ids",
        "order_product_ids",
        "pay_category_ids",
        "pay_product_ids",
        "city_id",
    )


def click_product_scan(spark: SparkSession, sf: str) -> DataFrame:
    return product_clicks(standins.user_visit_actions(spark, sf), TASK)


def user_scan(spark: SparkSession, sf: str) -> DataFrame:
    return standins.users(spark, sf)


def product_scan(spark: SparkSession, sf: str) -> DataFrame:
    return standins.products(spark, sf)


# Area products

def area_product_counts(spark: SparkSession, sf: str) -> DataFrame:
    return products.area_product_counts(click_product_scan(spark, sf))


def area_top3_products(spark: SparkSession, sf: str) -> DataFrame:
    return products.area_top_products(click_product_scan(spark, sf), standins.products(spark, sf))


def area_top3_products_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The same report written as SQL over views."""
    register_sql_functions(spark)
    views = {
        "product_clicks": click_product_scan(spark, sf),
        "product_info": standins.products(spark, sf),
        "city_info": F.broadcast(default_cities(spark)),
    }
    return spark.sql(
        """
        WITH by_city AS (
          SELECT city_id, product_id, count(*) AS clicks
          FROM {product_clicks} GROUP BY city_id, product_id),
        labelled AS (
          SELECT area, product_id, clicks, concat_long_string(city_id, city_name, ':') AS city
          FROM by_city JOIN {city_info} USING (city_id)),
        by_area AS (
          SELECT area, product_id, sum(clicks) AS click_count,
            listagg(DISTINCT city, ',') WITHIN GROUP (ORDER BY city) AS city_infos
          FROM labelled GROUP BY area, product_id),
        ranked AS (
          SELECT by_area.*, product_name,
            if(json_field(extend_info, 'product_status') = '0', 'Self', 'Third Party')
              AS product_status,
            row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS place
          FROM by_area JOIN {product_info} USING (product_id))
        SELECT area,
          CASE WHEN area IN ('华北', '华东') THEN 'A Level' WHEN area IN ('华南', '华中') THEN 'B Level'
               WHEN area IN ('西北', '西南') THEN 'C Level' ELSE 'D Level' END AS area_level,
          product_id, city_infos, click_count, product_name, product_status
        FROM ranked WHERE place <= 3
        """,
        **views,
    )


# Sessions

def session_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(spark, sf, ANYONE)


def session_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(spark, sf, TASK)


def session_filter_people(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(spark, sf, PEOPLE)


def session_filter_interests(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(spark, sf, INTERESTS)


def coded_session_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The same sessions by sets of dictionary codes."""
    return coded_sets.coded_sessions(
        _actions(spark, sf, ANYONE), standins.users(spark, sf), ANYONE
    )


def coded_session_interests(spark: SparkSession, sf: str) -> DataFrame:
    return coded_sets.coded_sessions(
        _actions(spark, sf, INTERESTS), standins.users(spark, sf), INTERESTS
    )


def session_visit_step_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.length_histogram(_sessions(spark, sf))


def session_visit_step_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.length_ratios(_sessions(spark, sf))


def session_detail(spark: SparkSession, sf: str) -> DataFrame:
    detail = sessions.session_detail(_actions(spark, sf), _sessions(spark, sf))
    return detail.drop("action_ts")


# Categories

def category_session_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _per_session(spark, sf)


def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return categories.category_counts(_per_session(spark, sf))


def top10_categories(spark: SparkSession, sf: str) -> DataFrame:
    return categories.top_categories(category_counts(spark, sf))


def top10_sessions_per_category(spark: SparkSession, sf: str) -> DataFrame:
    # Used twice with different columns; stored once, the log is scanned once.
    per_session = materialize(_per_session(spark, sf), "category-sessions")
    top = categories.top_categories(categories.category_counts(per_session))
    return categories.top_sessions(per_session, top)


def top_session_detail(spark: SparkSession, sf: str) -> DataFrame:
    top = top10_sessions_per_category(spark, sf)
    return categories.top_session_detail(_actions(spark, sf), top).drop("action_ts")


def top_session_detail_repeated(spark: SparkSession, sf: str) -> DataFrame:
    top = top10_sessions_per_category(spark, sf)
    return categories.top_session_detail(_actions(spark, sf), top, repeat=True).drop("action_ts")


# Sampling

def hourly_session_counts(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hourly_session_counts(_sessions(spark, sf))


def session_sample_quota(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_quota(hourly_session_counts(spark, sf))


def session_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_sessions(_sessions(spark, sf))


def session_sample_of_few(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_sessions(_sessions(spark, sf), FEW)


def session_extract(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.extract_report(_actions(spark, sf), session_sample(spark, sf))


def session_sample_detail(spark: SparkSession, sf: str) -> DataFrame:
    drawn = session_sample(spark, sf)
    return sampling.keep_actions_of(_actions(spark, sf), drawn, 100).drop("action_ts")


# Daily partials

def _daily(spark: SparkSession, sf: str) -> str:
    """Partials of all days; of one day, most of the log arrives after they were made."""
    raw = standins.user_visit_actions(spark, sf)
    folder = scratch_path(spark, "daily")
    dates = [row[0] for row in raw.select("date").distinct().collect()]
    daily.refresh(raw.filter((F.col("date") != LATE_DAY) | (F.col("page_id") < 3)), folder, dates)
    daily.refresh(raw, folder, [LATE_DAY])
    return folder


def _daily_sessions(spark: SparkSession, sf: str, folder: str, params: TaskParams) -> DataFrame:
    partials = daily.stored_sessions(spark, folder, params)
    summary = daily.merged_sessions(partials, params)
    return sessions.known_sessions(summary, standins.users(spark, sf), params)


def daily_session_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.length_ratios(_daily_sessions(spark, sf, _daily(spark, sf), TASK))


def daily_session_interests(spark: SparkSession, sf: str) -> DataFrame:
    return _daily_sessions(spark, sf, _daily(spark, sf), INTERESTS)


def daily_hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hourly_session_counts(_daily_sessions(spark, sf, _daily(spark, sf), TASK))


def daily_category_counts(spark: SparkSession, sf: str) -> DataFrame:
    folder = _daily(spark, sf)
    partials = daily.stored_categories(spark, folder, TASK)
    chosen = _daily_sessions(spark, sf, folder, TASK)
    return categories.category_counts(daily.merged_categories(partials, chosen))


# Page flow

def page_step_counts(spark: SparkSession, sf: str) -> DataFrame:
    steps = _steps(spark, sf).groupBy("page_id", "next_page_id")
    return steps.agg(F.sum("steps").alias("steps"))


def page_step_counts_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same with every session of two or more actions on the path of the heavy ones."""
    steps = pages.page_steps(_actions(spark, sf), heavy_rows=2).groupBy("page_id", "next_page_id")
    return steps.agg(F.sum("steps").alias("steps"))


def page_pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_pair_counts(_steps(spark, sf), TASK.page_pairs)


def page_start_pv(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_views(_actions(spark, sf), FLOW[0])


def page_conversion_rates(spark: SparkSession, sf: str) -> DataFrame:
    return pages.conversion_rates(_steps(spark, sf), FLOW)


def page_conversion_string(spark: SparkSession, sf: str) -> DataFrame:
    return pages.conversion_text(page_conversion_rates(spark, sf))


# Ad clicks as a batch

def ad_line_quality(spark: SparkSession, sf: str) -> DataFrame:
    # The names of the users stand for lines that are not in the format.
    junk = standins.users(spark, sf).select(F.col("name").alias("value"))
    return ads.line_quality(standins.ad_lines(spark, sf).unionByName(junk))


def ad_user_daily_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return ads.user_daily_clicks(_clicks(spark, sf))


def ad_blacklist_users(spark: SparkSession, sf: str) -> DataFrame:
    return ads.blacklisted_users(ad_user_daily_clicks(spark, sf), THRESHOLD)


def ad_clicks_without_blacklisted(spark: SparkSession, sf: str) -> DataFrame:
    banned = ads.user_bitmap(ad_blacklist_users(spark, sf))
    kept = ads.without_bitmap(_clicks(spark, sf), banned)
    return kept.withColumn("ts", F.unix_millis("ts"))


def ad_running_stat(spark: SparkSession, sf: str) -> DataFrame:
    return ads.running_totals(_clicks(spark, sf))


def ad_running_stat_without_blacklisted(spark: SparkSession, sf: str) -> DataFrame:
    # The list is counted before it is used; stored, it is computed once.
    listed = materialize(ad_blacklist_users(spark, sf), "blacklist")
    return ads.totals_without_users(_clicks(spark, sf), listed)


def ad_province_top3(spark: SparkSession, sf: str) -> DataFrame:
    return ads.top_ads_by_province(ad_running_stat(spark, sf))


def ad_click_trend(spark: SparkSession, sf: str) -> DataFrame:
    return ads.click_trend(_clicks(spark, sf))


def ad_click_trend_sliding(spark: SparkSession, sf: str) -> DataFrame:
    # A coarse slide: at 10 seconds every click is in 360 result windows.
    shown = ads.sliding_click_trend(_clicks(spark, sf), "60 minutes", "10 minutes")
    return shown.withColumn("window_end", dt.format_time(F.col("window_end")))


def _with_texts(runs: DataFrame) -> DataFrame:
    return runs.withColumns(
        {name: dt.format_time(F.col(name)) for name in ("first_end", "last_end")}
    )


def ad_click_trend_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The trend in windows of 60 minutes every 10 seconds."""
    return _with_texts(ads.window_runs(ads.slot_counts(_clicks(spark, sf))))


def ad_click_trend_at_noon(spark: SparkSession, sf: str) -> DataFrame:
    """What the window that ends at noon of a day shows, of the same trend."""
    runs = ads.window_runs(ads.slot_counts(_clicks(spark, sf)))
    return ads.shown_in_window(runs, F.lit(NOON).cast("timestamp"))


# Ad clicks as a stream

def _run_stream(spark: SparkSession, sf: str, start) -> AdStore:
    return _run_stream_in(spark, sf, start)[0]


def _run_stream_in(spark: SparkSession, sf: str, start) -> tuple[AdStore, str]:
    """Let the ad log arrive in parts and run the stream to its end after each.

    Every run resumes from the checkpoint of the one before, and each is one micro-batch.
    """
    folder = scratch_path(spark, "ad-stream")
    lines = standins.ad_lines(spark, sf)
    date = dt.format_date(dt.from_epoch_millis(F.substring_index("value", " ", 1).cast("long")))
    store = AdStore(f"{folder}/store")
    for i, first in enumerate(PART_STARTS):
        part = lines.filter(date >= first)
        if i + 1 < len(PART_STARTS):
            part = part.filter(date < PART_STARTS[i + 1])
        part.write.mode("append").text(f"{folder}/in")
        start(
            file_lines(spark, f"{folder}/in"),
            store,
            f"{folder}/checkpoint",
            AdSettings(threshold=THRESHOLD),
            available_now=True,
        ).awaitTermination()
    return store, f"{folder}/checkpoint"


def stream_running_stat(spark: SparkSession, sf: str) -> DataFrame:
    return _run_stream(spark, sf, start_ad_stats).totals.read(spark)


def stream_state_totals(spark: SparkSession, sf: str) -> DataFrame:
    """All clicks, as the state store of a stream that was resumed twice holds them."""
    return state_totals(spark, _run_stream_in(spark, sf, start_running_totals)[1])


def stream_user_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return _run_stream(spark, sf, start_ad_stats).user_clicks.read(spark)


def stream_blacklist(spark: SparkSession, sf: str) -> DataFrame:
    return _run_stream(spark, sf, start_ad_stats).blacklist.read(spark)


def stream_province_top3(spark: SparkSession, sf: str) -> DataFrame:
    return _run_stream(spark, sf, start_ad_stats).province_top.read(spark)


def stream_click_trend(spark: SparkSession, sf: str) -> DataFrame:
    return _run_stream(spark, sf, start_click_trend).trend.read(spark)


def stream_click_trend_sliding(spark: SparkSession, sf: str) -> DataFrame:
    store = _run_stream(spark, sf, start_click_trend)
    shown = sliding_trend(spark, store, "60 minutes", "10 minutes")
    return shown.withColumn("window_end", dt.format_time(F.col("window_end")))


def stream_click_trend_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _with_texts(trend_runs(spark, _run_stream(spark, sf, start_click_trend)))


# Functions

def datetime_scalars(spark: SparkSession, sf: str) -> DataFrame:
    log = standins.read(spark, sf, "events")
    first = F.concat_ws(" ", dt.format_date(F.col("ts")), F.lit("9:05:07"))
    time = dt.format_time(F.col("ts"))
    return log.select(
        "event_id",
        dt.before(time, first).alias("is_before"),
        dt.after(time, first).alias("is_after"),
        dt.minus_seconds(time, first).alias("seconds"),
        dt.date_hour(first).alias("date_hour"),
        dt.format_date(F.col("ts")).alias("date"),
        time.alias("time"),
        dt.format_date_key(F.col("ts")).alias("date_key"),
        dt.format_date(dt.parse_date_key(dt.format_date_key(F.col("ts")))).alias("parsed_date"),
        dt.format_minute_key(F.col("ts")).alias("minute_key"),
        dt.parse_time(F.lit("2024-02-31 10:00:00")).isNull().alias("no_such_day"),
        (dt.today() > dt.yesterday()).alias("today_after_yesterday"),
        dt.format_time(
            dt.from_epoch_millis(F.unix_millis(F.col("ts").cast("timestamp")))
        ).alias("from_millis"),
    )


def string_scalars(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    packed = F.concat(
        F.lit("sessionid="), key, F.lit("|city="), F.col("c_mktsegment"), F.lit("|sex=|age=4=2")
    )
    json = F.concat(F.lit('{"segment": "'), F.col("c_mktsegment"), F.lit('"}'))
    blank = F.when(key % 3 == 0, "").when(key % 3 == 1, F.col("c_name"))
    return standins.read(spark, sf, "customer").select(
        "c_custkey",
        text.is_empty(blank).alias("is_empty"),
        text.is_not_empty(blank).alias("is_not_empty"),
        text.trim_comma(F.concat(F.lit(",,"), "c_name", F.lit(",1,"))).alias("trimmed"),
        text.two_digits((key % 60).cast("string")).alias("two_digits"),
        text.packed_field(packed, "city").alias("city"),
        text.packed_field(packed, "sex").alias("no_value"),
        text.packed_field(packed, "age").alias("two_values"),
        text.packed_field(packed, "other").alias("no_field"),
        text.with_packed_field(packed, "city", F.col("c_name")).alias("replaced"),
        text.json_field(json, "segment").alias("segment"),
        text.id_with_name(key, F.col("c_name")).alias("id_name"),
        text.round_half_up((key % 1000) / 1000).alias("rounded"),
    )


def text_concat_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return (
        standins.read(spark, sf, "customer")
        .groupBy("c_nationkey")
        .agg(text.concat_distinct(F.col("c_mktsegment")).alias("segments"))
    )


def keyed_counter(spark: SparkSession, sf: str) -> DataFrame:
    return counters.count_by_key(standins.read(spark, sf, "events"), "event_type")


# Sinks

def sink_roundtrip_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "users-csv")
    batch_sinks.export_csv(standins.users(spark, sf), path)
    return spark.read.schema(schemas.USER_INFO).option("escape", '"').csv(path)


def sink_roundtrip_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "actions-json")
    batch_sinks.export_json(standins.user_visit_actions(spark, sf), path)
    return spark.read.schema(schemas.USER_VISIT_ACTION).json(path)


def sink_roundtrip_json_limit(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "users-json")
    first = standins.users(spark, sf).orderBy("user_id")
    batch_sinks.export_json(first, path, limit=100)
    return spark.read.schema(schemas.USER_INFO).json(path)


def sink_roundtrip_table(spark: SparkSession, sf: str) -> DataFrame:
    """The action log as a table partitioned by date, read back through its catalog name."""
    path = scratch_path(spark, "action-table")
    name = "t_" + path[-32:]
    batch_sinks.replace_table(standins.user_visit_actions(spark, sf), name, "date", path=path)
    # Partition values are read back with the type they had: text.
    return spark.table(name).select(*schemas.USER_VISIT_ACTION.names)


def sink_roundtrip_zorder(spark: SparkSession, sf: str) -> DataFrame:
    """The action log in Z-order of date, city and product, read back."""
    path = scratch_path(spark, "actions-zorder")
    columns = ["date", "city_id", "click_product_id"]
    zorder.write_z_ordered(standins.user_visit_actions(spark, sf), path, columns)
    return spark.read.schema(schemas.USER_VISIT_ACTION).parquet(path)


def _two_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The ad clicks up to the 20th, and those from the 11th on."""
    clicks = _clicks(spark, sf)
    return clicks.filter("date <= '2024-01-20'"), clicks.filter("date >= '2024-01-11'")


def sink_insert_new(spark: SparkSession, sf: str) -> DataFrame:
    stored, batch = _two_loads(spark, sf)
    columns = ["user_id", "ad_id"]
    seen = stored.groupBy(*columns).agg(F.min("date").alias("date"))
    return merge.insert_new(seen, batch.select(*columns, F.lit("new").alias("date")), columns)


def sink_add_counts(spark: SparkSession, sf: str) -> DataFrame:
    stored, batch = (ads.user_daily_clicks(load) for load in _two_loads(spark, sf))
    return merge.add_counts(stored, batch, ["date", "user_id", "ad_id"], "click_count")


def sink_overwrite_rows(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["province", "city", "ad_id"]
    stored, batch = (
        load.groupBy(*keys).agg(F.count(F.lit(1)).alias("click_count"))
        for load in _two_loads(spark, sf)
    )
    return merge.overwrite_rows(stored, batch, keys)


def sink_replace_group(spark: SparkSession, sf: str) -> DataFrame:
    stored, batch = (
        ads.top_ads_by_province(ads.running_totals(load)) for load in _two_loads(spark, sf)
    )
    return merge.overwrite_rows(stored, batch, ["date", "province"])


# Result tables of the jobs

def _report_query(table: str, build: Callable[[SparkSession, str], dict[str, DataFrame]]) -> Query:
    return lambda spark, sf: build(spark, sf)[table]


def _session_report(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    raw, people = standins.user_visit_actions(spark, sf), standins.users(spark, sf)
    return reports.session_report(raw, people, TASK, TASK_ID)


def _page_report(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return reports.page_report(standins.user_visit_actions(spark, sf), TASK, TASK_ID)


def _product_report(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    raw, goods = standins.user_visit_actions(spark, sf), standins.products(spark, sf)
    return reports.product_report(raw, goods, TASK, task_id=TASK_ID)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        action_scan,
        click_product_scan,
        user_scan,
        product_scan,
        area_product_counts,
        area_top3_products,
        area_top3_products_sql,
        session_rollup,
        session_filter,
        session_filter_people,
        session_filter_interests,
        coded_session_rollup,
        coded_session_interests,
        session_visit_step_histogram,
        session_visit_step_ratios,
        session_detail,
        category_session_counts,
        category_counts,
        top10_categories,
        top10_sessions_per_category,
        top_session_detail,
        top_session_detail_repeated,
        hourly_session_counts,
        session_sample_quota,
        session_sample,
        session_sample_of_few,
        session_extract,
        session_sample_detail,
        daily_session_ratios,
        daily_session_interests,
        daily_hourly_counts,
        daily_category_counts,
        page_step_counts,
        page_step_counts_split,
        page_pair_counts,
        page_start_pv,
        page_conversion_rates,
        page_conversion_string,
        ad_line_quality,
        ad_user_daily_clicks,
        ad_blacklist_users,
        ad_clicks_without_blacklisted,
        ad_running_stat,
        ad_running_stat_without_blacklisted,
        ad_province_top3,
        ad_click_trend,
        ad_click_trend_sliding,
        ad_click_trend_runs,
        ad_click_trend_at_noon,
        stream_running_stat,
        stream_state_totals,
        stream_user_clicks,
        stream_blacklist,
        stream_province_top3,
        stream_click_trend,
        stream_click_trend_sliding,
        stream_click_trend_runs,
        datetime_scalars,
        string_scalars,
        text_concat_distinct,
        keyed_counter,
        sink_roundtrip_csv,
        sink_roundtrip_json,
        sink_roundtrip_json_limit,
        sink_roundtrip_table,
        sink_roundtrip_zorder,
        sink_insert_new,
        sink_add_counts,
        sink_overwrite_rows,
        sink_replace_group,
    )
} | {
    f"report_{table}": _report_query(table, build)
    for build, tables in (
        (
            _session_report,
            (
                "session_aggr_stat",
                "session_random_extract",
                "session_detail",
                "top10_category",
                "top10_session",
            ),
        ),
        (_page_report, ("page_split_convert_rate",)),
        (_product_report, ("area_top3_product",)),
    )
    for table in tables
}
