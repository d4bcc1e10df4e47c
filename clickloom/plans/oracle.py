"""The registered queries as DuckDB SQL over the same test tables."""

from __future__ import annotations

import re

from clickloom.operators.sessions import STEP_BUCKETS, VISIT_BUCKETS
from clickloom.plans.queries import (
    DAYS,
    FEW,
    FLOW,
    INTERESTS,
    NOON,
    PART_STARTS,
    PEOPLE,
    TASK,
    TASK_ID,
    THRESHOLD,
)
from clickloom.sources.standins import AGES, HOURS, WORDS, YOUNGEST
from clickloom.sources.tables import CITIES


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_K = "CAST(regexp_extract(props, '\"k\": (\\d+)', 1) AS BIGINT)"

# Views, each usable on its own after the ones it names.
_VIEWS = {
    "raw_actions": f"""
        SELECT strftime(ts, '%Y-%m-%d') AS date, user_id,
          user_id || '_' || strftime(ts, '%Y%m%d') AS session_id,
          k % 10 AS page_id,
          strftime(ts, '%Y-%m-%d') || ' ' || (user_id * 7 % {HOURS}) || ':'
            || lpad(CAST((event_id * 37 % 3540) // 60 AS VARCHAR), 2, '0') || ':'
            || lpad(CAST((event_id * 37 % 3540) % 60 AS VARCHAR), 2, '0') AS action_time,
          CASE WHEN event_type = 'view' THEN {_list(WORDS)}[event_id % {len(WORDS)} + 1] END AS search_keyword,
          CASE WHEN event_type = 'click' THEN (event_id * 7 + k) % 20 ELSE -1 END AS click_category_id,
          CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_product_id,
          CASE WHEN event_type = 'purchase' THEN (k % 20) || ',' || ((k + 7) % 20) END
            AS order_category_ids,
          CASE WHEN event_type = 'purchase' THEN k || ',' || ((k + 31) % 100) END
            AS order_product_ids,
          CASE WHEN event_type = 'signup' THEN CAST(k % 20 AS VARCHAR) END AS pay_category_ids,
          CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
          event_id % 10 AS city_id
        FROM (SELECT *, {_K} AS k FROM events)""",
    "actions": f"""
        SELECT * REPLACE (nullif(click_category_id, -1) AS click_category_id,
                          nullif(click_product_id, -1) AS click_product_id),
          strptime(action_time, '%Y-%m-%d %H:%M:%S') AS action_ts
        FROM raw_actions
        WHERE date >= '{DAYS["start_date"]}' AND date <= '{DAYS["end_date"]}'""",
    "detail_columns": """
        SELECT * EXCLUDE (action_ts) FROM actions""",
    "user_info": f"""
        SELECT c_custkey AS user_id, 'shopper-' || c_custkey AS username, c_name AS name,
          CAST({YOUNGEST} + c_custkey % {AGES} AS INTEGER) AS age, c_mktsegment AS professional, n_name AS city,
          CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "product_info": """
        SELECT p_partkey AS product_id, p_name AS product_name,
          '{"product_status": ' || (p_partkey % 2) || '}' AS extend_info
        FROM part""",
    "city_info": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{name}', '{area}')" for i, name, area in CITIES)
    + ") AS t(city_id, city_name, area)",
    "product_clicks": """
        SELECT city_id, click_product_id AS product_id FROM actions
        WHERE click_product_id IS NOT NULL""",
    "area_counts": """
        SELECT area, product_id, count(*) AS click_count,
          string_agg(DISTINCT city_id || ':' || city_name, ','
                     ORDER BY city_id || ':' || city_name) AS city_infos
        FROM product_clicks JOIN city_info USING (city_id) GROUP BY area, product_id""",
    "area_top": """
        SELECT area,
          CASE WHEN area IN ('华北', '华东') THEN 'A Level' WHEN area IN ('华南', '华中') THEN 'B Level'
               WHEN area IN ('西北', '西南') THEN 'C Level' ELSE 'D Level' END AS area_level,
          product_id, city_infos, click_count, product_name,
          CASE WHEN regexp_extract(extend_info, 'product_status": (\\d)', 1) = '0'
               THEN 'Self' ELSE 'Third Party' END AS product_status
        FROM area_counts JOIN product_info USING (product_id)
        QUALIFY row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) <= 3""",
    "all_sessions": """
        SELECT session_id, user_id, start_time, visit_length, step_length, search_keywords,
          click_category_ids, age, professional, city, sex
        FROM (
          SELECT session_id, min(user_id) AS user_id,
            strftime(min(action_ts), '%Y-%m-%d %H:%M:%S') AS start_time,
            date_diff('second', min(action_ts), max(action_ts)) AS visit_length,
            count(*) AS step_length,
            string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword) AS search_keywords,
            array_to_string(list_sort(list(DISTINCT click_category_id)
              FILTER (WHERE click_category_id IS NOT NULL)), ',') AS click_category_ids
          FROM actions GROUP BY session_id)
        JOIN user_info USING (user_id)""",
    "sessions": f"""
        SELECT * FROM all_sessions WHERE age BETWEEN {TASK.start_age} AND {TASK.end_age}""",
    "histogram": "SELECT count(*) AS session_count, "
    + ", ".join(
        f"count(*) FILTER (WHERE {source} >= {low}"
        + (f" AND {source} <= {high}" if high is not None else "")
        + f") AS {name}"
        for source, buckets in (("visit_length", VISIT_BUCKETS), ("step_length", STEP_BUCKETS))
        for name, low, high in buckets
    )
    + " FROM sessions",
    "ratios": "SELECT session_count, "
    + ", ".join(
        f"((200 * {name} + session_count) // (2 * nullif(session_count, 0))) / 100.0 AS {name}_ratio"
        for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS
    )
    + " FROM histogram",
    "category_rows": """
        SELECT session_id, click_category_id AS category_id, 'click' AS kind FROM actions
        WHERE click_category_id IS NOT NULL
        UNION ALL
        SELECT session_id, CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 'order'
        FROM actions WHERE order_category_ids IS NOT NULL
        UNION ALL
        SELECT session_id, CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 'pay'
        FROM actions WHERE pay_category_ids IS NOT NULL""",
    "category_sessions": """
        SELECT session_id, category_id, count(*) FILTER (WHERE kind = 'click') AS click_count,
          count(*) FILTER (WHERE kind = 'order') AS order_count,
          count(*) FILTER (WHERE kind = 'pay') AS pay_count
        FROM category_rows WHERE session_id IN (SELECT session_id FROM sessions)
        GROUP BY session_id, category_id""",
    "category_totals": """
        SELECT category_id, CAST(sum(click_count) AS BIGINT) AS click_count,
          CAST(sum(order_count) AS BIGINT) AS order_count,
          CAST(sum(pay_count) AS BIGINT) AS pay_count
        FROM category_sessions GROUP BY category_id""",
    "top_category": """
        SELECT * FROM category_totals
        ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10""",
    "top_session": """
        SELECT category_id, session_id, click_count FROM category_sessions
        WHERE click_count > 0 AND category_id IN (SELECT category_id FROM top_category)
        QUALIFY row_number() OVER (PARTITION BY category_id
                                   ORDER BY click_count DESC, session_id) <= 10""",
    "stamped": """
        SELECT session_id, start_time, start_time[1:10] AS date, start_time[12:13] AS hour
        FROM sessions""",
    "hourly": """
        SELECT date, hour, count(*) AS session_count FROM stamped GROUP BY date, hour""",
    "day_rows": """
        SELECT date, sum(session_count) AS n, row_number() OVER (ORDER BY sum(session_count), date) AS i,
          count(*) OVER () AS days FROM hourly GROUP BY date""",
    "day_quota": """
        SELECT date, n AS day_count, CASE WHEN i < k THEN n
            ELSE r // (days - k + 1) + CASE WHEN early <= r % (days - k + 1) THEN 1 ELSE 0 END END AS per_day
        FROM (SELECT a.*, k, r, row_number() OVER (PARTITION BY i < k ORDER BY date) AS early
              FROM day_rows a, (
                SELECT coalesce(min(i), max(days) + 1) AS k,
                  coalesce(min_by(rest, i), 0) AS r, max(days) AS d
                FROM (SELECT d.*, :sample_size: - coalesce((SELECT sum(n) FROM day_rows e WHERE e.i < d.i), 0) AS rest
                      FROM day_rows d)
                WHERE n * (days - i + 1) > rest))""",
    "shares": """
        SELECT date, hour, session_count, per_day, day_count, session_count * per_day AS product
        FROM hourly JOIN day_quota USING (date)""",
    "quota": """
        SELECT date, hour, session_count,
          CAST(product // day_count + CASE WHEN place <= spare THEN 1 ELSE 0 END AS BIGINT) AS quota
        FROM (
          SELECT *, per_day - sum(product // day_count) OVER (PARTITION BY date) AS spare,
            row_number() OVER (PARTITION BY date ORDER BY product % day_count DESC, hour) AS place
          FROM shares)""",
    "drawn": """
        SELECT date, hour, session_id, start_time
        FROM (SELECT *, row_number() OVER (PARTITION BY date, hour
                ORDER BY md5(session_id || '#42'), session_id) AS place FROM stamped)
        JOIN quota USING (date, hour) WHERE place <= quota""",
    "extract": """
        SELECT session_id, d.start_time, search_keywords, click_category_ids
        FROM drawn d JOIN all_sessions USING (session_id)""",
    "steps": """
        SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_ts, page_id)
          AS next_page_id FROM actions""",
    "pair_flow": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(zip(FLOW, FLOW[1:]), start=1))
    + ") AS t(position, a, b)",
    "flow_pv": f"""
        SELECT position, a || '_' || b AS pair, count(page_id) AS pv
        FROM pair_flow LEFT JOIN steps ON page_id = a AND next_page_id = b GROUP BY position, a, b
        UNION ALL SELECT 0, 'start', count(*) FROM actions WHERE page_id = {FLOW[0]}""",
    "rates": """
        SELECT position, pair, pv, previous_pv,
          CASE WHEN previous_pv > 0
               THEN ((200 * pv + previous_pv) // (2 * previous_pv)) / 100.0 END AS rate
        FROM (SELECT *, lag(pv) OVER (ORDER BY position) AS previous_pv FROM flow_pv)
        WHERE position > 0""",
    "rate_text": """
        SELECT string_agg(pair || '=' || coalesce(CAST(rate AS VARCHAR), 'null'), '|'
                          ORDER BY position) AS convert_rate FROM rates""",
    "clicks": f"""
        SELECT strftime(ts, '%Y-%m-%d') AS date, ts, epoch_us(ts) // 1000 AS millis,
          CAST(user_id % 10 AS VARCHAR) AS province, CAST(event_id % 10 AS VARCHAR) AS city,
          user_id, {_K} % 30 AS ad_id
        FROM events""",
    "daily": """
        SELECT date, user_id, ad_id, count(*) AS click_count FROM clicks GROUP BY ALL""",
    "banned": f"""
        SELECT DISTINCT user_id FROM daily WHERE click_count >= {THRESHOLD}""",
    "totals": """
        SELECT date, province, city, ad_id, count(*) AS click_count FROM clicks GROUP BY ALL""",
    "parted": "SELECT *, CASE "
    + " ".join(
        f"WHEN date >= '{first}' THEN {i}" for i, first in reversed(list(enumerate(PART_STARTS)))
    )
    + " END AS part FROM clicks",
    # The part in which a user first has enough clicks on one ad and day.
    "crossed": f"""
        SELECT user_id, min(part) AS part
        FROM (SELECT user_id, part,
                sum(count(*)) OVER (PARTITION BY user_id, date, ad_id ORDER BY part) AS n
              FROM parted GROUP BY user_id, date, ad_id, part)
        WHERE n >= {THRESHOLD} GROUP BY user_id""",
    "kept": """
        SELECT p.* FROM parted p LEFT JOIN crossed c ON p.user_id = c.user_id
        WHERE c.part IS NULL OR p.part <= c.part""",
    "kept_totals": """
        SELECT date, province, city, ad_id, count(*) AS click_count FROM kept GROUP BY ALL""",
    "load_1": "SELECT * FROM clicks WHERE date <= '2024-01-20'",
    "load_2": "SELECT * FROM clicks WHERE date >= '2024-01-11'",
}


def _sql(select: str, sample_size: int = 100) -> str:
    """``select`` with the views it mentions, directly or through other views, in front."""
    needed: set[str] = set()
    texts = [select]
    while texts:
        text = texts.pop()
        for name, view in _VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                texts.append(view)
    views = [f"{name} AS ({view})" for name, view in _VIEWS.items() if name in needed]
    sql = f"WITH {', '.join(views)} {select}" if views else select
    return sql.replace(":sample_size:", str(sample_size))


def _where(sessions: str) -> str:
    return f"SELECT * FROM all_sessions WHERE {sessions}"


def _province_top(totals: str) -> str:
    return f"""
        SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
        FROM {totals} GROUP BY date, province, ad_id
        QUALIFY row_number() OVER (PARTITION BY date, province
                                   ORDER BY sum(click_count) DESC, ad_id) <= 3"""


def _group_top(load: str) -> str:
    return _province_top(f"(SELECT *, 1 AS click_count FROM {load})")


_DETAIL_RECORD = f"""
    SELECT '{TASK_ID}' AS taskid, user_id AS userid, session_id AS sessionid, page_id AS pageid,
      action_time AS "actionTime", search_keyword AS "searchKeyword",
      coalesce(click_category_id, -1) AS "clickCategoryId",
      coalesce(click_product_id, -1) AS "clickProductId",
      order_category_ids AS "orderCategoryIds", order_product_ids AS "orderProductIds",
      pay_category_ids AS "payCategoryIds", pay_product_ids AS "payProductIds"
    FROM actions"""

_SELECTS = {
    "action_scan": """
        SELECT * EXCLUDE (action_ts)
          REPLACE (strftime(action_ts, '%Y-%m-%d %H:%M:%S') AS action_time) FROM actions""",
    "click_product_scan": "SELECT * FROM product_clicks",
    "user_scan": "SELECT * FROM user_info",
    "product_scan": "SELECT * FROM product_info",
    "area_product_counts": "SELECT * FROM area_counts",
    "area_top3_products": "SELECT * FROM area_top",
    "session_rollup": "SELECT * FROM all_sessions",
    "session_filter": "SELECT * FROM sessions",
    "session_filter_people": _where(
        f"age BETWEEN {PEOPLE.start_age} AND {PEOPLE.end_age} "
        f"AND list_contains({_list(PEOPLE.professionals)}, professional) "
        f"AND list_contains({_list(PEOPLE.cities)}, city) AND sex = '{PEOPLE.sex}'"
    ),
    "session_filter_interests": _where(
        f"list_has_any(string_split(search_keywords, ','), {_list(INTERESTS.keywords)}) "
        f"AND list_has_any(string_split(click_category_ids, ','), {_list(INTERESTS.category_ids)})"
    ),
    "session_visit_step_histogram": "SELECT * FROM histogram",
    "session_visit_step_ratios": "SELECT * FROM ratios",
    "session_detail": """
        SELECT * FROM detail_columns WHERE session_id IN (SELECT session_id FROM sessions)""",
    "category_session_counts": "SELECT * FROM category_sessions",
    "category_counts": "SELECT * FROM category_totals",
    "top10_categories": "SELECT * FROM top_category",
    "top10_sessions_per_category": "SELECT * FROM top_session",
    "top_session_detail": """
        SELECT * FROM detail_columns WHERE session_id IN (SELECT session_id FROM top_session)""",
    "top_session_detail_repeated": """
        SELECT d.* FROM detail_columns d JOIN top_session t ON d.session_id = t.session_id""",
    "hourly_session_counts": "SELECT * FROM hourly",
    "session_sample_quota": "SELECT * FROM quota",
    "session_sample": "SELECT * FROM drawn",
    "session_extract": "SELECT * FROM extract",
    "session_sample_detail": """
        SELECT * FROM detail_columns WHERE session_id IN (SELECT session_id FROM drawn)""",
    "page_step_counts": """
        SELECT page_id, next_page_id, count(*) AS steps FROM steps GROUP BY ALL""",
    "page_pair_counts": """
        SELECT pair, pv FROM flow_pv WHERE position > 0 AND pv > 0""",
    "page_start_pv": f"SELECT count(*) AS start_pv FROM actions WHERE page_id = {FLOW[0]}",
    "page_conversion_rates": "SELECT * FROM rates",
    "page_conversion_string": "SELECT * FROM rate_text",
    "ad_line_quality": """
        SELECT (SELECT count(*) FROM clicks) + (SELECT count(*) FROM user_info) AS line_count,
          (SELECT count(*) FROM user_info) AS malformed_count""",
    "ad_user_daily_clicks": "SELECT * FROM daily",
    "ad_blacklist_users": "SELECT * FROM banned",
    "ad_clicks_without_blacklisted": """
        SELECT date, millis AS ts, province, city, user_id, ad_id FROM clicks
        WHERE user_id NOT IN (SELECT user_id FROM banned)""",
    "ad_running_stat": "SELECT * FROM totals",
    "ad_running_stat_without_blacklisted": """
        SELECT date, province, city, ad_id, count(*) AS click_count FROM clicks
        WHERE user_id NOT IN (SELECT user_id FROM banned) GROUP BY ALL""",
    "ad_province_top3": _province_top("totals"),
    "ad_click_trend": """
        SELECT date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, ad_id,
          count(*) AS click_count FROM clicks GROUP BY ALL""",
    "ad_click_trend_sliding": """
        SELECT strftime(time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' * (i + 1),
                        '%Y-%m-%d %H:%M:%S') AS window_end,
          date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, ad_id,
          count(*) AS click_count
        FROM clicks, range(6) AS t(i) GROUP BY ALL""",
    # The expanded form, a row for each window, then put together where counts are equal.
    "ad_click_trend_runs": """
        SELECT strftime(min(e), '%Y-%m-%d %H:%M:%S') AS first_end,
          strftime(max(e), '%Y-%m-%d %H:%M:%S') AS last_end,
          strftime(m, '%Y-%m-%d') AS date, strftime(m, '%H') AS hour, strftime(m, '%M') AS minute,
          ad_id, n AS click_count
        FROM (SELECT *, epoch(e) // 10 - row_number() OVER (PARTITION BY m, ad_id, n ORDER BY e) AS run
              FROM (SELECT date_trunc('minute', ts) AS m, ad_id,
                      time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' * (i + 1) AS e,
                      count(*) AS n
                    FROM clicks, range(360) AS t(i) GROUP BY ALL))
        GROUP BY m, ad_id, n, run""",
    "ad_click_trend_at_noon": f"""
        SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,
          strftime(ts, '%M') AS minute, ad_id, count(*) AS click_count
        FROM clicks WHERE ts >= TIMESTAMP '{NOON}' - INTERVAL '1 hour' AND ts < TIMESTAMP '{NOON}'
        GROUP BY ALL""",
    "stream_running_stat": "SELECT * FROM kept_totals",
    "stream_user_clicks": """
        SELECT date, user_id, ad_id, count(*) AS click_count FROM kept GROUP BY ALL""",
    "stream_blacklist": "SELECT user_id FROM crossed",
    "stream_province_top3": _province_top("kept_totals"),
    "datetime_scalars": """
        SELECT event_id, t < nine AS is_before, t > nine AS is_after,
          date_diff('second', nine, t) AS seconds,
          strftime(nine, '%Y-%m-%d_%H') AS date_hour, strftime(ts, '%Y-%m-%d') AS date,
          strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, strftime(ts, '%Y%m%d') AS date_key,
          strftime(ts, '%Y-%m-%d') AS parsed_date, strftime(ts, '%Y%m%d%H%M') AS minute_key,
          true AS no_such_day, true AS today_after_yesterday,
          strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_millis
        FROM (SELECT event_id, ts, date_trunc('second', ts) AS t,
                date_trunc('day', ts) + INTERVAL '9 hours 5 minutes 7 seconds' AS nine FROM events)""",
    "string_scalars": """
        SELECT c_custkey, c_custkey % 3 <> 1 AS is_empty, c_custkey % 3 = 1 AS is_not_empty,
          c_name || ',1' AS trimmed, lpad(CAST(c_custkey % 60 AS VARCHAR), 2, '0') AS two_digits,
          c_mktsegment AS city, CAST(NULL AS VARCHAR) AS no_value,
          CAST(NULL AS VARCHAR) AS two_values, CAST(NULL AS VARCHAR) AS no_field,
          'sessionid=' || c_custkey || '|city=' || c_name || '|sex=|age=4=2' AS replaced,
          c_mktsegment AS segment, c_custkey || ':' || c_name AS id_name,
          ((200 * (c_custkey % 1000) + 1000) // 2000) / 100.0 AS rounded
        FROM customer""",
    "text_concat_distinct": """
        SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments
        FROM customer GROUP BY c_nationkey""",
    "keyed_counter": """
        SELECT event_type AS key, count(*) AS "count" FROM events GROUP BY event_type""",
    "sink_roundtrip_csv": "SELECT * FROM user_info",
    "sink_roundtrip_json": "SELECT * FROM raw_actions",
    "sink_roundtrip_json_limit": "SELECT * FROM user_info ORDER BY user_id LIMIT 100",
    "sink_roundtrip_table": "SELECT * FROM raw_actions",
    "sink_insert_new": """
        SELECT user_id, ad_id, coalesce(min(date) FILTER (WHERE date <= '2024-01-20'), 'new') AS date
        FROM clicks GROUP BY user_id, ad_id""",
    "sink_add_counts": """
        SELECT date, user_id, ad_id, count(*) AS click_count
        FROM (SELECT * FROM load_1 UNION ALL SELECT * FROM load_2) GROUP BY ALL""",
    "sink_overwrite_rows": """
        SELECT province, city, ad_id, CAST(coalesce(b.n, a.n) AS BIGINT) AS click_count
        FROM (SELECT province, city, ad_id, count(*) AS n FROM load_1 GROUP BY ALL) a
        FULL JOIN (SELECT province, city, ad_id, count(*) AS n FROM load_2 GROUP BY ALL) b
        USING (province, city, ad_id)""",
    "sink_replace_group": f"""
        SELECT * FROM ({_group_top("load_2")}) UNION ALL
        SELECT * FROM ({_group_top("load_1")})
        WHERE (date, province) NOT IN (SELECT (date, province) FROM load_2)""",
    "report_session_aggr_stat": f"SELECT '{TASK_ID}' AS taskid, * FROM ratios",
    "report_session_random_extract": f"""
        SELECT '{TASK_ID}' AS taskid, session_id AS sessionid, start_time AS "startTime",
          search_keywords AS "searchKeywords", click_category_ids AS "clickCategoryIds"
        FROM extract""",
    "report_session_detail": f"""
        {_DETAIL_RECORD} WHERE session_id IN (SELECT session_id FROM drawn)
        UNION ALL {_DETAIL_RECORD} WHERE session_id IN (SELECT session_id FROM top_session)""",
    "report_top10_category": f"""
        SELECT '{TASK_ID}' AS taskid, category_id AS categoryid, click_count AS "clickCount",
          order_count AS "orderCount", pay_count AS "payCount" FROM top_category""",
    "report_top10_session": f"""
        SELECT '{TASK_ID}' AS taskid, category_id AS categoryid, session_id AS sessionid,
          click_count AS "clickCount" FROM top_session""",
    "report_page_split_convert_rate": f"""
        SELECT '{TASK_ID}' AS taskid, convert_rate AS "convertRate" FROM rate_text""",
    "report_area_top3_product": f"""
        SELECT '{TASK_ID}' AS taskid, area, area_level AS "areaLevel", product_id AS productid,
          city_infos AS "cityInfos", click_count AS "clickCount", product_name AS "productName",
          product_status AS "productStatus" FROM area_top""",
}
_SELECTS["area_top3_products_sql"] = _SELECTS["area_top3_products"]
_SELECTS["page_step_counts_split"] = _SELECTS["page_step_counts"]
_SELECTS["stream_click_trend"] = _SELECTS["ad_click_trend"]
_SELECTS["stream_click_trend_runs"] = _SELECTS["ad_click_trend_runs"]
_SELECTS["stream_click_trend_sliding"] = _SELECTS["ad_click_trend_sliding"]

_SELECTS["stream_state_totals"] = _SELECTS["ad_running_stat"]
_SELECTS["sink_roundtrip_zorder"] = _SELECTS["sink_roundtrip_table"]
_SELECTS["coded_session_rollup"] = _SELECTS["session_rollup"]
_SELECTS["coded_session_interests"] = _SELECTS["session_filter_interests"]
_SELECTS["daily_session_ratios"] = _SELECTS["session_visit_step_ratios"]
_SELECTS["daily_session_interests"] = _SELECTS["session_filter_interests"]
_SELECTS["daily_hourly_counts"] = _SELECTS["hourly_session_counts"]
_SELECTS["daily_category_counts"] = _SELECTS["category_counts"]

ORACLE: dict[str, str] = {name: _sql(select) for name, select in _SELECTS.items()}
ORACLE["session_sample_of_few"] = _sql(_SELECTS["session_sample"], FEW)
