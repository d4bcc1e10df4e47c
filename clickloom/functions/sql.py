"""Helpers for users who write SQL text.

They are SQL-bodied functions, so Catalyst inlines them. The third helper of an area query,
a distinct concatenation, is Spark's own ``listagg(DISTINCT ...)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_FUNCTIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(
         id BIGINT, name STRING, separator STRING)
       RETURNS STRING RETURN concat(CAST(id AS STRING), separator, name)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION json_field(json STRING, field STRING)
       RETURNS STRING RETURN get_json_object(json, concat('$.', field))""",
)


def register_sql_functions(spark: SparkSession) -> None:
    """Define ``concat_long_string(id, name, separator)`` and ``json_field(json, field)``."""
    for statement in _FUNCTIONS:
        spark.sql(statement)
