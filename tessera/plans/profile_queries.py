"""App-profile queries bound to the driver tables.

Binding: an "open" of app ``l_partkey`` by user ``o_custkey`` on the day of
``o_orderdate`` for every line item; installs = distinct (user, app); app
metadata = ``part`` (category = p_type, sub-category = p_brand, tags = the
space-separated words of p_name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.maps import merge_map
from ..operators import profile as P
from ..sources.tables import Tables
from .common import array_text, map_text, register

TAG_SEP = " "


def opens(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = t.lineitem.select("l_orderkey", "l_partkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select(F.col("o_custkey").alias("guid"), F.col("l_partkey").alias("app_name"),
                      F.date_format("o_orderdate", "yyyyMMdd").alias("day")))


def installs(t: Tables) -> DataFrame:
    return opens(t).select("guid", "app_name").distinct()


def meta(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("app_name"), F.col("p_type").alias("category"),
                         F.col("p_brand").alias("sub_category"), F.col("p_name").alias("tags"))


def dims(t: Tables) -> dict[str, DataFrame]:
    return P.app_dimensions(meta(t), TAG_SEP)


_OPENS_SQL = """
  (SELECT o_custkey AS guid, l_partkey AS app_name, strftime(o_orderdate, '%Y%m%d') AS day
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_INSTALLS_SQL = f"(SELECT DISTINCT guid, app_name FROM {_OPENS_SQL} x)"
_TAGS_SQL = """
  (SELECT p_partkey AS app_name, unnest(string_split(p_name, ' ')) AS tag
   FROM part WHERE p_name IS NOT NULL AND length(p_name) > 0)"""


@register("app_open_days_times", f"""
SELECT guid, app_name, CAST(count(DISTINCT day) AS BIGINT) AS day_count, CAST(count(day) AS BIGINT) AS times
FROM {_OPENS_SQL} a
GROUP BY guid, app_name
""")
def app_open_days_times(t: Tables) -> DataFrame:
    """AGG-01: per user and app, distinct open days and opens."""
    return P.open_app_stats(opens(t))


def _open_dim_sql(key: str, col: str) -> str:
    return f"""
SELECT guid, {col} AS {key}, CAST(count(DISTINCT day) AS BIGINT) AS days, CAST(count(day) AS BIGINT) AS times
FROM {_OPENS_SQL} a JOIN part ON a.app_name = p_partkey
WHERE {col} IS NOT NULL AND length({col}) > 0
GROUP BY guid, {col}
"""


@register("open_by_category", _open_dim_sql("category", "p_type"))
def open_by_category(t: Tables) -> DataFrame:
    """AGG-02."""
    return P.open_dim_stats(opens(t), dims(t)["category"], "category")


@register("open_by_subcategory", _open_dim_sql("sub_category", "p_brand"))
def open_by_subcategory(t: Tables) -> DataFrame:
    """AGG-03."""
    return P.open_dim_stats(opens(t), dims(t)["sub_category"], "sub_category")


@register("open_by_tag", f"""
SELECT guid, tag, CAST(count(DISTINCT day) AS BIGINT) AS days, CAST(count(day) AS BIGINT) AS times
FROM {_OPENS_SQL} a JOIN {_TAGS_SQL} g ON a.app_name = g.app_name
GROUP BY guid, tag
""")
def open_by_tag(t: Tables) -> DataFrame:
    """AGG-04."""
    return P.open_dim_stats(opens(t), dims(t)["tag"], "tag")


def _install_dim_sql(key: str, col: str) -> str:
    return f"""
SELECT guid, {col} AS {key}, CAST(count(DISTINCT i.app_name) AS BIGINT) AS count
FROM {_INSTALLS_SQL} i JOIN part ON i.app_name = p_partkey
WHERE {col} IS NOT NULL AND length({col}) > 0
GROUP BY guid, {col}
"""


@register("install_by_category", _install_dim_sql("category", "p_type"))
def install_by_category(t: Tables) -> DataFrame:
    """AGG-05."""
    return P.install_dim_counts(installs(t), dims(t)["category"], "category")


@register("install_by_subcategory", _install_dim_sql("sub_category", "p_brand"))
def install_by_subcategory(t: Tables) -> DataFrame:
    """AGG-06."""
    return P.install_dim_counts(installs(t), dims(t)["sub_category"], "sub_category")


@register("install_by_tag", f"""
SELECT DISTINCT guid, tag, CAST(1 AS BIGINT) AS count
FROM {_INSTALLS_SQL} i JOIN {_TAGS_SQL} g ON i.app_name = g.app_name
""")
def install_by_tag(t: Tables) -> DataFrame:
    """AGG-07 (presence: always 1, as the reference)."""
    return P.install_tag_counts(installs(t), dims(t)["tag"])


@register("installed_list", f"""
SELECT guid, string_agg(CAST(app_name AS VARCHAR), ',' ORDER BY app_name) AS install_app
FROM {_INSTALLS_SQL} i GROUP BY guid
""")
def installed_list(t: Tables) -> DataFrame:
    """AGG-09: sorted installed-app list per user (as text)."""
    return P.installed_list(installs(t)).select("guid", array_text("install_app").alias("install_app"))


def _kv(key: str, val: str) -> str:
    return f"string_agg(CAST({key} AS VARCHAR) || '=' || CAST({val} AS VARCHAR), ',' ORDER BY {key})"


@register("app_profile", f"""
WITH o AS {_OPENS_SQL},
i AS (SELECT DISTINCT guid, app_name FROM o),
tags AS {_TAGS_SQL},
inst AS (SELECT guid, string_agg(CAST(app_name AS VARCHAR), ',' ORDER BY app_name) AS install_app FROM i GROUP BY guid),
icat AS (SELECT guid, {_kv('k', 'n')} AS m FROM (
    SELECT guid, p_type AS k, count(DISTINCT app_name) AS n FROM i JOIN part ON app_name = p_partkey
    WHERE p_type IS NOT NULL AND length(p_type) > 0 GROUP BY 1, 2) GROUP BY guid),
isub AS (SELECT guid, {_kv('k', 'n')} AS m FROM (
    SELECT guid, p_brand AS k, count(DISTINCT app_name) AS n FROM i JOIN part ON app_name = p_partkey
    WHERE p_brand IS NOT NULL AND length(p_brand) > 0 GROUP BY 1, 2) GROUP BY guid),
itag AS (SELECT guid, {_kv('k', '1')} AS m FROM (
    SELECT DISTINCT guid, tag AS k FROM i JOIN tags USING (app_name)) GROUP BY guid),
oapp AS (SELECT guid, {_kv('app_name', 'd')} AS md, {_kv('app_name', 'n')} AS mt FROM (
    SELECT guid, app_name, count(DISTINCT day) AS d, count(day) AS n FROM o GROUP BY 1, 2) GROUP BY guid),
ocat AS (SELECT guid, {_kv('k', 'd')} AS md, {_kv('k', 'n')} AS mt FROM (
    SELECT guid, p_type AS k, count(DISTINCT day) AS d, count(day) AS n FROM o JOIN part ON app_name = p_partkey
    WHERE p_type IS NOT NULL AND length(p_type) > 0 GROUP BY 1, 2) GROUP BY guid),
osub AS (SELECT guid, {_kv('k', 'd')} AS md, {_kv('k', 'n')} AS mt FROM (
    SELECT guid, p_brand AS k, count(DISTINCT day) AS d, count(day) AS n FROM o JOIN part ON app_name = p_partkey
    WHERE p_brand IS NOT NULL AND length(p_brand) > 0 GROUP BY 1, 2) GROUP BY guid),
otag AS (SELECT guid, {_kv('k', 'd')} AS md, {_kv('k', 'n')} AS mt FROM (
    SELECT guid, tag AS k, count(DISTINCT day) AS d, count(day) AS n FROM o JOIN tags USING (app_name)
    GROUP BY 1, 2) GROUP BY guid)
SELECT inst.guid, install_app, icat.m AS install_category_count, isub.m AS install_subcategory_count,
       itag.m AS install_tag_count, oapp.md AS open_app_days, oapp.mt AS open_app_times,
       ocat.md AS open_category_days, ocat.mt AS open_category_times,
       osub.md AS open_subcategory_days, osub.mt AS open_subcategory_times,
       otag.md AS open_tag_days, otag.mt AS open_tag_times, '20240101' AS date_p
FROM inst LEFT JOIN icat USING (guid) LEFT JOIN isub USING (guid) LEFT JOIN itag USING (guid)
LEFT JOIN oapp USING (guid) LEFT JOIN ocat USING (guid) LEFT JOIN osub USING (guid) LEFT JOIN otag USING (guid)
""")
def app_profile(t: Tables) -> DataFrame:
    """PRO-04: the full per-user profile (maps rendered as sorted text)."""
    df = P.app_profile(None, opens(t), meta(t), "20240101", TAG_SEP)
    out = []
    for c in df.columns:
        if c in ("guid", "date_p"):
            out.append(F.col(c))
        elif c == "install_app":
            out.append(array_text(c).alias(c))
        else:
            out.append(map_text(c).alias(c))
    return df.select(*out)


@register("tag_distribution", """
WITH cells AS (
  SELECT CAST(l_partkey AS VARCHAR) AS tagid,
         string_agg(CAST(l_quantity AS VARCHAR) || ':' || CAST(n AS VARCHAR), chr(9) ORDER BY l_quantity) AS distr
  FROM (SELECT l_partkey, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY l_partkey),
t AS (SELECT CAST(tagid AS BIGINT) AS tagid, distr FROM cells WHERE tagid <> '\\N'),
b AS (SELECT CASE WHEN tagid >= 1120000000 AND tagid < 1130000000 THEN 'producer'
                  WHEN tagid >= 1110000000 AND tagid < 1120000000 THEN 'interest'
                  WHEN tagid >= 1500 AND tagid < 1980 THEN 'mp_media'
                  WHEN tagid >= 3000000 AND tagid < 3001506 THEN 'function' END AS band, distr FROM t),
kv AS (SELECT band, unnest(string_split(distr, chr(9))) AS kv FROM b WHERE band IS NOT NULL)
SELECT band, CAST(split_part(kv, ':', 1) AS DOUBLE) AS k, CAST(sum(CAST(split_part(kv, ':', 2) AS BIGINT)) AS BIGINT) AS sum_v
FROM kv GROUP BY 1, 2
""")
def tag_distribution(t: Tables) -> DataFrame:
    """PRO-05 + GEN-07 + FLT-04/06: histogram cells built from the quantity
    histogram of each part (tag id = part key), parsed back and summed per band."""
    li = t.lineitem
    hist = li.groupBy("l_partkey", "l_quantity").agg(F.count(F.lit(1)).alias("n"))
    cells = hist.groupBy("l_partkey").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_quantity", "n"))),
                                 lambda e: F.concat(e["l_quantity"].cast("string"), F.lit(":"),
                                                    e["n"].cast("string"))), "\t").alias("distr"))
    df = cells.select(F.col("l_partkey").cast("string").alias("tagid"), "distr")
    return P.tag_distribution(df)


@register("merge_map_last", """
WITH last AS (SELECT user_id, event_type, last(value ORDER BY ts, event_id) AS v
              FROM events WHERE event_type IS NOT NULL GROUP BY user_id, event_type)
SELECT user_id, string_agg(event_type || '=' || CAST(v AS VARCHAR), ',' ORDER BY event_type) AS merged
FROM last GROUP BY user_id
""")
def merge_map_last(t: Tables) -> DataFrame:
    """AGG-17 / UDF-04: per user, event type -> value of the latest event
    (order (ts, event_id)), rendered as sorted text."""
    m = merge_map(t.events, ["user_id"], "event_type", "value", ["ts", "event_id"])
    return m.select("user_id", map_text("merged").alias("merged"))
