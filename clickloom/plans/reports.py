"""The batch jobs: each returns its result tables, stamped with the task id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import categories, pages, products, sampling, sessions
from clickloom.params import TaskParams, new_task_id
from clickloom.session import materialize
from clickloom.sources.tables import actions_in_range, product_clicks


def _record(df: DataFrame, schema, task_id: str, **columns: str | Column) -> DataFrame:
    """Project to a result schema; a column not named keeps its own name."""
    values = {"taskid": F.lit(task_id), **columns}
    return df.select(
        *[
            (F.col(value) if isinstance(value, str) else value)
            .cast(field.dataType)
            .alias(field.name)
            for field in schema.fields
            for value in [values.get(field.name, field.name)]
        ]
    )


def session_aggr_stat(ratios: DataFrame, task_id: str) -> DataFrame:
    return _record(ratios, schemas.SESSION_AGGR_STAT, task_id)


def session_random_extract(extract: DataFrame, task_id: str) -> DataFrame:
    return _record(
        extract,
        schemas.SESSION_RANDOM_EXTRACT,
        task_id,
        sessionid="session_id",
        startTime="start_time",
        searchKeywords="search_keywords",
        clickCategoryIds="click_category_ids",
    )


def session_detail(actions: DataFrame, task_id: str) -> DataFrame:
    """The stored form writes an absent click category or product as -1, like the log."""
    return _record(
        actions,
        schemas.SESSION_DETAIL,
        task_id,
        userid="user_id",
        sessionid="session_id",
        pageid="page_id",
        actionTime="action_time",
        searchKeyword="search_keyword",
        clickCategoryId=F.coalesce(F.col("click_category_id"), F.lit(-1)),
        clickProductId=F.coalesce(F.col("click_product_id"), F.lit(-1)),
        orderCategoryIds="order_category_ids",
        orderProductIds="order_product_ids",
        payCategoryIds="pay_category_ids",
        payProductIds="pay_product_ids",
    )


def top10_category(top: DataFrame, task_id: str) -> DataFrame:
    return _record(
        top,
        schemas.TOP10_CATEGORY,
        task_id,
        categoryid="category_id",
        clickCount="click_count",
        orderCount="order_count",
        payCount="pay_count",
    )


def top10_session(top: DataFrame, task_id: str) -> DataFrame:
    return _record(
        top,
        schemas.TOP10_SESSION,
        task_id,
        categoryid="category_id",
        sessionid="session_id",
        clickCount="click_count",
    )


def _actions_of_both(
    actions: DataFrame, drawn: DataFrame, busiest: DataFrame, sample_size: int
) -> DataFrame:
    """Actions of the drawn and of the busiest sessions, in one pass over the log.

    A session that is in both is reported for each.
    """
    keys = drawn.select("session_id").unionByName(busiest.select("session_id").distinct())
    if sample_size <= sampling.MAX_BROADCAST_SAMPLE:
        keys = F.broadcast(keys)
    return actions.join(keys, "session_id")


def session_report(
    raw_actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    task_id: str | None = None,
    sample_size: int = 100,
    seed: int = 42,
    keep: Callable[[DataFrame, str], DataFrame] = materialize,
) -> dict[str, DataFrame]:
    """The session job's result tables.

    The filtered sessions and the per-category counts each feed several tables, so ``keep``
    stores them once in the shared folder. The two small selections are stored too: a table
    and the detail that belongs to it then come from the same rows.
    """
    task_id = task_id or new_task_id()
    actions = actions_in_range(raw_actions, params)
    slim = sessions.filtered_sessions(actions, users, params).select(
        "session_id", "start_time", "visit_length", "step_length"
    )
    chosen = keep(slim, "sessions")
    drawn = keep(sampling.sample_sessions(chosen, sample_size, seed), "drawn-sessions")
    per_session = keep(categories.category_session_counts(actions, chosen), "category-sessions")
    top = keep(categories.top_categories(categories.category_counts(per_session)), "top-categories")
    busiest = keep(categories.top_sessions(per_session, top), "top-sessions")
    return {
        "session_aggr_stat": session_aggr_stat(sessions.length_ratios(chosen), task_id),
        "session_random_extract": session_random_extract(
            sampling.extract_report(actions, drawn, sample_size), task_id
        ),
        "session_detail": session_detail(
            _actions_of_both(actions, drawn, busiest, sample_size), task_id
        ),
        "top10_category": top10_category(top, task_id),
        "top10_session": top10_session(busiest, task_id),
    }


def page_report(
    raw_actions: DataFrame, params: TaskParams, task_id: str | None = None
) -> dict[str, DataFrame]:
    """The page-flow job's result table."""
    task_id = task_id or new_task_id()
    steps = pages.page_steps(actions_in_range(raw_actions, params))
    text = pages.conversion_text(pages.conversion_rates(steps, params.target_page_flow))
    record = _record(text, schemas.PAGE_SPLIT_CONVERT_RATE, task_id, convertRate="convert_rate")
    return {"page_split_convert_rate": record}


def product_report(
    raw_actions: DataFrame,
    product_info: DataFrame,
    params: TaskParams,
    cities: DataFrame | None = None,
    task_id: str | None = None,
) -> dict[str, DataFrame]:
    """The area-product job's result table."""
    task_id = task_id or new_task_id()
    top = products.area_top_products(product_clicks(raw_actions, params), product_info, cities)
    record = _record(
        top,
        schemas.AREA_TOP3_PRODUCT,
        task_id,
        areaLevel="area_level",
        productid="product_id",
        cityInfos="city_infos",
        clickCount="click_count",
        productName="product_name",
        productStatus="product_status",
    )
    return {"area_top3_product": record}


def write_report(report: dict[str, DataFrame], write: Callable[[DataFrame, str], None]) -> None:
    """Hand every table to a sink, for example
    ``lambda df, table: append_jdbc(df, target, table)``."""
    for table, df in report.items():
        write(df, table)
