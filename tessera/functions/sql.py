"""UDF-02/03 for SQL users: the scalar helpers as session SQL functions
(``CREATE TEMPORARY FUNCTION ... RETURN <expression>``), so they stay
Catalyst expressions -- no JVM or Python UDF objects."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The SQL bodies of the Column helpers in scalar.py and geo.py.
SQL_FUNCTIONS = {
    "say_hello": "(name STRING) RETURNS STRING RETURN concat('hello , ', name)",
    "list_contains": ("(lst ARRAY<STRING>, s STRING) RETURNS BOOLEAN RETURN "
                      "CASE WHEN lst IS NULL OR s IS NULL THEN NULL ELSE exists(lst, x -> x <=> s) END"),
    "safe_div": ("(x BIGINT) RETURNS BIGINT RETURN "
                 "CASE WHEN x = 0 THEN 0 ELSE CAST(100 / x AS BIGINT) END"),
    "clean_sentinel": ("(s STRING) RETURNS STRING RETURN "
                       "CASE WHEN lower(s) IN ('null', '\\\\n') THEN NULL ELSE s END"),
    "name_id": ("(s STRING) RETURNS BIGINT RETURN "
                "CAST(conv(concat(substr(md5(s), 1, 12), '3', substr(md5(s), 14, 3)), 16, -10) AS BIGINT)"),
    # bisection, one bit a step, longitude first; NULL outside the globe
    "geohash": ("(lat DOUBLE, lon DOUBLE, n INT) RETURNS STRING RETURN "
                "CASE WHEN lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 THEN "
                "substr(aggregate(sequence(0, 59), named_struct('x', -180D, 'w', 360D, 'y', -90D, 'h', 180D, 'code', 0L), "
                "(s, i) -> if(i % 2 = 0, "
                "named_struct('x', if(lon >= s.x + s.w / 2, s.x + s.w / 2, s.x), 'w', s.w / 2, 'y', s.y, 'h', s.h, "
                "'code', s.code * 2 + if(lon >= s.x + s.w / 2, 1L, 0L)), "
                "named_struct('x', s.x, 'w', s.w, 'y', if(lat >= s.y + s.h / 2, s.y + s.h / 2, s.y), 'h', s.h / 2, "
                "'code', s.code * 2 + if(lat >= s.y + s.h / 2, 1L, 0L))), "
                "s -> array_join(transform(sequence(0, 11), c -> "
                "substr('0123456789bcdefghjkmnpqrstuvwxyz', 1 + CAST(shiftright(s.code, 55 - 5 * c) & 31 AS INT), 1)), '')), "
                "1, greatest(1, least(12, n))) END"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the helpers as temporary SQL functions of this session."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return sorted(SQL_FUNCTIONS)


def register_views(views: dict) -> list[str]:
    """TBL-07: expose DataFrames to SQL users as session temp views
    (``{"dm_category": df, ...}``); the operators themselves never need them."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
