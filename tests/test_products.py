from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.text import parsed_json, variant_field
from clickloom.operators import products
from clickloom.sources.tables import product_clicks


@pytest.fixture(scope="module")
def goods(rows):
    return rows(
        schemas.PRODUCT_INFO,
        *[
            {
                "product_id": i,
                "product_name": f"p{i}",
                "extend_info": f'{{"product_status": {i % 2}}}' if i else None,
            }
            for i in range(9)
        ],
    )


def _clicks(spark, *pairs):
    return spark.createDataFrame(
        [pair[:2] for pair in pairs for _ in range(pair[2])], "city_id long, product_id long"
    )


def test_top_products(spark, goods):
    clicks = _clicks(
        spark, (1, 7, 5), (2, 7, 4), (1, 2, 3), (1, 4, 3), (2, 6, 3), (9, 0, 1), (1, 99, 50), (88, 1, 9)
    )
    got = {
        (r.area, r.product_id): r for r in products.area_top_products(clicks, goods).collect()
    }
    # The unknown product 99 takes no place; equal counts rank by product id.
    assert set(got) == {("华东", 7), ("华东", 2), ("华东", 4), ("东北", 0)}
    best = got["华东", 7]
    assert (best.click_count, best.city_infos, best.area_level) == (9, "1:上海,2:南京", "A Level")
    assert (best.product_name, best.product_status) == ("p7", "Third Party")
    assert got["华东", 2].product_status == "Self"
    assert (got["东北", 0].area_level, got["东北", 0].product_status) == ("D Level", "Third Party")


def test_city_whose_text_is_inside_another(spark, rows):
    cities = rows(
        schemas.CITY_INFO,
        {"city_id": 1, "city_name": "x", "area": "a"},
        {"city_id": 11, "city_name": "x", "area": "a"},
    )
    counts = products.area_product_counts(_clicks(spark, (11, 5, 1), (1, 5, 2)), cities)
    assert counts.first().city_infos == "11:x,1:x"


@pytest.mark.parametrize(
    "area, level",
    [
        ("China North", "A Level"),
        ("华北", "A Level"),
        ("China Middle", "B Level"),
        ("华南", "B Level"),
        ("West South", "C Level"),
        ("西北", "C Level"),
        ("东北", "D Level"),
        (None, "D Level"),
    ],
)
def test_area_level(spark, area, level):
    column = products.area_level(F.lit(area).cast("string"))
    assert spark.range(1).select(column.alias("v")).first().v == level


def test_click_scan_leaves_out_other_actions(log, november):
    raw = log(
        {"click_product_id": 5},
        {"click_product_id": -1},
        {"click_product_id": None},
        {"click_product_id": 6, "date": "2017-12-01"},
    )
    assert [tuple(r) for r in product_clicks(raw, november).collect()] == [(0, 5)]


@pytest.mark.parametrize(
    "json, field, status",
    [
        ('{"product_status": 0}', "0", "Self"),
        ('{"product_status": "0", "a": [1, {"product_status": 1}]}', "0", "Self"),
        ('{"product_status": 1}', "1", "Third Party"),
        ('{"a": {"product_status": 0}}', None, "Third Party"),
        ('{"product_status": null}', None, "Third Party"),
        ('{"product_status": 0', None, "Third Party"),
        ("not json", None, "Third Party"),
        ("[0]", None, "Third Party"),
        ("", None, "Third Party"),
        (None, None, "Third Party"),
    ],
)
def test_status_of_any_text(spark, json, field, status):
    text = F.lit(json).cast("string")
    row = spark.range(1).select(
        variant_field(parsed_json(text), "product_status").alias("field"),
        products.product_status(text).alias("status"),
    )
    assert tuple(row.first()) == (field, status)


def test_fields_have_types(spark):
    variant = parsed_json(F.lit('{"n": 5, "s": "x", "d": "2017-11-10"}'))
    row = spark.range(1).select(
        variant_field(variant, "n", "long").alias("a"),
        variant_field(variant, "s", "long").alias("b"),
        variant_field(variant, "d", "date").cast("string").alias("c"),
    )
    assert tuple(row.first()) == (5, None, "2017-11-10")
