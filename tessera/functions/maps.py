"""AGG-08 / AGG-17: map-valued aggregates built from built-in aggregates.

``merge_map`` reproduces a map-collecting aggregate (null keys skipped, null
values kept, a later value wins).  "Later" is made explicit by an order key,
so the result does not depend on partitioning.  The plan is two ordinary
aggregations: ``max_by`` per (group, key) -- partial/final, so a hot group is
pre-aggregated map-side -- and then one ``collect_list`` per group whose size
is bounded by the number of distinct keys, not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import as_col


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [as_col(x) for x in xs]


def last_value_per_key(df: DataFrame, group_cols: Sequence[str], key: str, value: str,
                       order_by: Sequence[str]) -> DataFrame:
    """Long form of ``merge_map``: one row ``(group..., key, value)`` per key,
    value taken from the row with the greatest ``order_by``."""
    order = F.struct(*_cols(order_by))
    return (df.where(F.col(key).isNotNull())
              .groupBy(*group_cols, key)
              .agg(F.max_by(F.struct(F.col(value).alias("v")), order)["v"].alias(value)))


def merge_map(df: DataFrame, group_cols: Sequence[str], key: str, value: str,
              order_by: Sequence[str], out: str = "merged") -> DataFrame:
    """AGG-17 / UDF-04: ``(group..., out map<key, value>)``."""
    if not key or not value:
        raise TypeError("merge_map takes exactly two arguments: a key column and a value column")
    long = last_value_per_key(df, group_cols, key, value, order_by)
    return (long.groupBy(*group_cols)
                .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), F.col(value))))).alias(out)))


def count_map(df: DataFrame, group_col: str, key: str, count: str, out: str) -> DataFrame:
    """AGG-08: ``(group, map<key, count>)`` from an already aggregated long
    table with one row per (group, key).  Keys are unique per group, so
    ``map_from_entries`` never sees duplicates (Spark would raise on them)."""
    return (df.groupBy(group_col)
              .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), F.col(count))))).alias(out)))


def merge_maps_last_wins(maps: Column) -> Column:
    """MAP-02: merge an array of maps, later maps winning on equal keys.

    Works without touching ``mapKeyDedupPolicy``: entries are reversed so the
    first occurrence of a key is the winner, and duplicates are filtered out
    before ``map_from_entries``.
    """
    entries = F.reverse(F.flatten(F.transform(maps, lambda m: F.map_entries(m))))
    keys = F.transform(entries, lambda e: e["key"])
    firsts = F.filter(entries, lambda e, i: F.array_position(keys, e["key"]) == i + 1)
    return F.map_from_entries(firsts)
