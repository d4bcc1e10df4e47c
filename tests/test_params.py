from __future__ import annotations

from clickloom import TaskParams

PROPERTY_TEXT = """{startDate:"2024-03-05", endDate:"2024-04-07", startAge: 18, endAge: 64,
  professionals: "", cities: "", sex:"", keywords:"a: b,c", categoryIds:"1,2",
  targetPageFlow:"3,1,4,5"}"""


def test_unquoted_keys():
    params = TaskParams.from_json(PROPERTY_TEXT)
    assert (params.start_date, params.end_date) == ("2024-03-05", "2024-04-07")
    assert (params.start_age, params.end_age) == (18, 64)
    assert params.professionals == params.cities == ()
    assert params.sex is None
    assert params.keywords == ("a: b", "c")
    assert params.category_ids == ("1", "2")
    assert params.page_pairs == [(3, 1), (1, 4), (4, 5)]


def test_strict_json_and_missing_fields():
    params = TaskParams.from_json('{"startDate": "2017-11-10", "endDate": "2017-11-12"}')
    assert params == TaskParams("2017-11-10", "2017-11-12")
