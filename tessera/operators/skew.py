"""Joins that stay balanced when one key holds a large share of the rows.

Adaptive skew splitting needs a bare shuffle on both join sides; a side that
is an aggregate on the join key does not qualify.  The joins here therefore
separate heavy keys themselves.  With ``n`` rows in total and ``p`` partitions,
fewer than ``p`` keys can hold more than ``n / p`` rows, so the heavy side of
the lookup has fewer than ``p`` rows by arithmetic and may be broadcast;
every other key fits an average partition and is joined by shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def width(df: DataFrame) -> int:
    """Shuffle partitions of the session of ``df``."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over the session's cores where its scan has fewer partitions (a
    file of few row groups); larger inputs are left where they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df``, marked for broadcast if its counted ``rows`` fit the session's bound."""
    bound = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(df) if rows * row_bytes <= bound else df


def sized(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``small``, and no broadcast at all beyond the bound: Spark's own estimate goes by
    the compressed bytes of a scan, which may hold many times as many in memory."""
    kept = small(df, rows, row_bytes)
    return kept if kept is not df else df.hint("merge")


def join_counted(rows: DataFrame, lookup: DataFrame, key: str | Sequence[str], n: str, total: int,
                 how: str = "inner") -> DataFrame:
    """``rows JOIN lookup`` on ``key`` (``how`` inner or left).

    ``lookup`` has one row per key; its column ``n`` is (an upper bound of)
    the number of rows with that key in ``rows`` and ``total`` at least the
    sum of ``n``.  ``rows`` and ``lookup`` are read twice: pass materialised
    or cheap inputs."""
    keys = [key] if isinstance(key, str) else list(key)
    limit = total // width(rows)
    heavy = F.broadcast(lookup.where(F.col(n) > limit))
    light = lookup.where(F.col(n) <= limit)
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return rows.join(heavy, keys).unionByName(rest.join(light, keys, how))
