"""Streaming queries: ``events`` replayed through the file stream source.

Each run reads the events file as a stream with ``availableNow``, counts
event types per tumbling window, and returns every window of the replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import files, sinks
from ..sources.tables import Tables
from ..streaming import wordcount as W
from .common import register, scratch

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _windowed(t: Tables, window: str, name: str) -> DataFrame:
    stream = (t.spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", "events.parquet")
              .parquet(t.sf_dir.rstrip("/")))
    rows = stream.select(W.ntz_as_utc_instant("ts").alias("ts"), F.col("event_type").alias("word"))
    parts = t.spark.sparkContext.defaultParallelism  # a bounded replay: one state store per core
    out = W.replay(W.tumbling_word_count(rows, "ts", window, None), ["window_start", "window_end", "word"], name, parts)
    fmt = "yyyy-MM-dd HH:mm:ss"
    return out.select(F.date_format(W.instant_as_utc_ntz("window_start"), fmt).alias("window_start"),
                      F.date_format(W.instant_as_utc_ntz("window_end"), fmt).alias("window_end"), "word", "count")


def _oracle(interval: str) -> str:
    return f"""
WITH b AS (SELECT time_bucket(INTERVAL {interval}, ts) AS ws, event_type FROM events)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(ws + INTERVAL {interval}, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type AS word, count(*) AS count
FROM b GROUP BY ws, event_type
"""


@register("tumbling_word_count", _oracle("1 HOUR"))
def tumbling_word_count(t: Tables) -> DataFrame:
    """STM-01: event types per 1-hour tumbling window, streamed."""
    return _windowed(t, "1 hour", "hourly")


@register("tumbling_word_count_3s", _oracle("3 SECOND"))
def tumbling_word_count_3s(t: Tables) -> DataFrame:
    """STM-01: event types per 3-second tumbling window (the reference's size)."""
    return _windowed(t, "3 seconds", "three_seconds")


@register("closing_windows", """
WITH w AS (SELECT unnest([l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m')]) AS word FROM lineitem)
SELECT word, count(*) AS count, CAST(0 AS BIGINT) AS repeated FROM w GROUP BY word
""")
def closing_windows(t: Tables) -> DataFrame:
    """STM-02/03: words of all ``lineitem`` lines counted in processing-time windows of
    two seconds that close by a timer after the last row.  Which rows share a window
    depends on the clock, so the windows are summed; ``repeated``: rows beyond one per
    word and window."""
    with scratch(t.spark) as path:
        sinks.write_text(t.lineitem.select(F.concat_ws("\t", "l_returnflag", "l_linestatus", F.date_format("l_shipdate", "yyyy-MM")).alias("line")), path)
        lines = files.stream_lines(t.spark, "text", path, wholetext="false", lineSep="\n")
        counts = W.closing_word_count(W.words(lines, "value", "\t", keep=()), 2)
        out = W.run_until_closed(counts, "closing", state_partitions=t.spark.sparkContext.defaultParallelism)
    return out.groupBy("word").agg(F.sum("count").alias("count"),
                                   (F.count(F.lit(1)) - F.count_distinct("window_start")).alias("repeated"))
