"""String and number helpers as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_empty(text: Column) -> Column:
    return F.nullif(text, F.lit("")).isNull()


def is_not_empty(text: Column) -> Column:
    return ~is_empty(text)


def trim_comma(text: Column) -> Column:
    """Without the commas at either end."""
    return F.btrim(text, F.lit(","))


def two_digits(text: Column) -> Column:
    """A leading zero unless the text already has two characters."""
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def packed_field(text: Column, field: str, delimiter: str = "|") -> Column:
    """Value of ``field`` in a packed ``key=value|key=value`` text.

    NULL when the field is absent, has no value, or its value holds a further ``=``.
    """
    parts = F.split(text, re.escape(delimiter))
    pattern = f"^{re.escape(field)}=[^=]+$"
    found = F.get(F.filter(parts, lambda part: part.rlike(pattern)), F.lit(0))
    return F.substring(found, len(field) + 2, 2**31 - 1)


def with_packed_field(text: Column, field: str, value: Column, delimiter: str = "|") -> Column:
    """The packed text with the value of ``field`` replaced; unchanged when it is absent."""
    parts = F.split(text, re.escape(delimiter))
    replaced = F.transform(
        parts,
        lambda part: F.when(
            F.substring_index(part, "=", 1) == field, F.concat(F.lit(f"{field}="), value)
        ).otherwise(part),
    )
    return F.array_join(replaced, delimiter)


def json_field(json: Column, field: str) -> Column:
    """Top-level field of a JSON text, by its bare name."""
    return F.get_json_object(json, f"$.{field}")


def parsed_json(json: Column) -> Column:
    """A JSON text as a VARIANT, parsed once for all its fields; NULL when malformed."""
    return F.try_parse_json(json)


def variant_field(variant: Column, field: str, type_: str = "string") -> Column:
    """Top-level field of a VARIANT; NULL when it is absent or not of the type."""
    return F.try_variant_get(variant, f"$.{field}", type_)


def id_with_name(id_: Column, name: Column, separator: str = ":") -> Column:
    """``id:name``; NULL when either is."""
    return F.concat(id_.cast("string"), F.lit(separator), name)


def concat_distinct(text: Column, separator: str = ",") -> Column:
    """Aggregate: the distinct texts of a group, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(text)), separator)


def round_half_up(value: Column, scale: int = 2) -> Column:
    return F.round(value, scale)
