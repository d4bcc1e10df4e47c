"""Input and output schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _LONG, _INT, _DBL = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


USER_VISIT_ACTION = _schema(
    ("date", _STR),
    ("user_id", _LONG),
    ("session_id", _STR),
    ("page_id", _LONG),
    ("action_time", _STR),
    ("search_keyword", _STR),
    ("click_category_id", _LONG),
    ("click_product_id", _LONG),
    ("order_category_ids", _STR),
    ("order_product_ids", _STR),
    ("pay_category_ids", _STR),
    ("pay_product_ids", _STR),
    ("city_id", _LONG),
)

USER_INFO = _schema(
    ("user_id", _LONG),
    ("username", _STR),
    ("name", _STR),
    ("age", _INT),
    ("professional", _STR),
    ("city", _STR),
    ("sex", _STR),
)

PRODUCT_INFO = _schema(("product_id", _LONG), ("product_name", _STR), ("extend_info", _STR))

CITY_INFO = _schema(("city_id", _LONG), ("city_name", _STR), ("area", _STR))

# Result tables, with the column names their readers expect.
SESSION_AGGR_STAT = _schema(
    ("taskid", _STR),
    ("session_count", _LONG),
    ("visit_length_1s_3s_ratio", _DBL),
    ("visit_length_4s_6s_ratio", _DBL),
    ("visit_length_7s_9s_ratio", _DBL),
    ("visit_length_10s_30s_ratio", _DBL),
    ("visit_length_30s_60s_ratio", _DBL),
    ("visit_length_1m_3m_ratio", _DBL),
    ("visit_length_3m_10m_ratio", _DBL),
    ("visit_length_10m_30m_ratio", _DBL),
    ("visit_length_30m_ratio", _DBL),
    ("step_length_1_3_ratio", _DBL),
    ("step_length_4_6_ratio", _DBL),
    ("step_length_7_9_ratio", _DBL),
    ("step_length_10_30_ratio", _DBL),
    ("step_length_30_60_ratio", _DBL),
    ("step_length_60_ratio", _DBL),
)

SESSION_RANDOM_EXTRACT = _schema(
    ("taskid", _STR),
    ("sessionid", _STR),
    ("startTime", _STR),
    ("searchKeywords", _STR),
    ("clickCategoryIds", _STR),
)

SESSION_DETAIL = _schema(
    ("taskid", _STR),
    ("userid", _LONG),
    ("sessionid", _STR),
    ("pageid", _LONG),
    ("actionTime", _STR),
    ("searchKeyword", _STR),
    ("clickCategoryId", _LONG),
    ("clickProductId", _LONG),
    ("orderCategoryIds", _STR),
    ("orderProductIds", _STR),
    ("payCategoryIds", _STR),
    ("payProductIds", _STR),
)

TOP10_CATEGORY = _schema(
    ("taskid", _STR),
    ("categoryid", _LONG),
    ("clickCount", _LONG),
    ("orderCount", _LONG),
    ("payCount", _LONG),
)

TOP10_SESSION = _schema(
    ("taskid", _STR), ("categoryid", _LONG), ("sessionid", _STR), ("clickCount", _LONG)
)

PAGE_SPLIT_CONVERT_RATE = _schema(("taskid", _STR), ("convertRate", _STR))

AREA_TOP3_PRODUCT = _schema(
    ("taskid", _STR),
    ("area", _STR),
    ("areaLevel", _STR),
    ("productid", _LONG),
    ("cityInfos", _STR),
    ("clickCount", _LONG),
    ("productName", _STR),
    ("productStatus", _STR),
)

# Ad tables, in the names the operators use; ``AD_RECORD_NAMES`` maps to the stored names.
AD_BLACKLIST = _schema(("user_id", _LONG))
AD_USER_CLICK_COUNT = _schema(
    ("date", _STR), ("user_id", _LONG), ("ad_id", _LONG), ("click_count", _LONG)
)
AD_BATCH = _schema(
    ("date", _STR),
    ("user_id", _LONG),
    ("province", _STR),
    ("city", _STR),
    ("ad_id", _LONG),
    ("click_count", _LONG),
)
AD_STAT = _schema(
    ("date", _STR),
    ("province", _STR),
    ("city", _STR),
    ("ad_id", _LONG),
    ("click_count", _LONG),
)
AD_PROVINCE_TOP3 = _schema(
    ("date", _STR), ("province", _STR), ("ad_id", _LONG), ("click_count", _LONG)
)
AD_CLICK_TREND = _schema(
    ("date", _STR),
    ("hour", _STR),
    ("minute", _STR),
    ("ad_id", _LONG),
    ("click_count", _LONG),
)
AD_CLICK_SLOT = _schema(("date", _STR), ("slot", _STR), ("ad_id", _LONG), ("click_count", _LONG))
AD_RECORD_NAMES = {"user_id": "userid", "ad_id": "adid", "click_count": "clickCount"}
