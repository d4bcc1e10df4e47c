"""Task parameters: the query a user of the batch jobs writes."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from typing import Any

_STRING_OR_BARE_KEY = re.compile(r'("(?:[^"\\]|\\.)*")|([A-Za-z_]\w*)(?=\s*:)')


def new_task_id() -> str:
    """A fresh id that stamps every row one run writes."""
    return str(uuid.uuid4())


def _items(value: Any) -> tuple[str, ...]:
    if value is None or value == "":
        return ()
    if isinstance(value, str):
        return tuple(value.split(","))
    return tuple(str(item) for item in value)


def _number(value: Any) -> int | None:
    return None if value is None or value == "" else int(value)


@dataclass(frozen=True)
class TaskParams:
    """One analysis task. An empty field means "no such filter".

    The dates are compared as text, so an end date such as ``2017-11-31`` is legal.
    """

    start_date: str
    end_date: str
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[str, ...] = ()
    target_page_flow: tuple[int, ...] = ()

    @classmethod
    def from_mapping(cls, values: dict[str, Any]) -> TaskParams:
        """From the camel-case parameter names (``startDate``, ``targetPageFlow``, ...)."""
        return cls(
            start_date=values["startDate"],
            end_date=values["endDate"],
            start_age=_number(values.get("startAge")),
            end_age=_number(values.get("endAge")),
            professionals=_items(values.get("professionals")),
            cities=_items(values.get("cities")),
            sex=values.get("sex") or None,
            keywords=_items(values.get("keywords")),
            category_ids=_items(values.get("categoryIds")),
            target_page_flow=tuple(int(p) for p in _items(values.get("targetPageFlow"))),
        )

    @classmethod
    def from_json(cls, text: str) -> TaskParams:
        """From JSON text; keys may be unquoted, as in a property file."""
        quoted = _STRING_OR_BARE_KEY.sub(lambda m: m.group(1) or f'"{m.group(2)}"', text)
        return cls.from_mapping(json.loads(quoted))

    @property
    def page_pairs(self) -> list[tuple[int, int]]:
        """Consecutive pages of the target flow, in order."""
        return list(zip(self.target_page_flow, self.target_page_flow[1:]))
