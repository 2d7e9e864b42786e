"""Structured Streaming word count and log-record stream (STM-01 .. STM-04,
SRC-14, SNK-05).

The reference counts words of a line stream in 3-second processing-time
windows and emits one row per closed window.  Here the window is declared on
a time column: ``with_processing_time`` stamps rows with the micro-batch time
(the reference's time domain), while tests and the registered query use the
event time so results are reproducible.  Append mode with a lateness bound emits
a window exactly once, when it can get no more rows; the state store keeps only
open windows, so state is bounded by the number of (open window, word) pairs,
not by the stream length.  A bounded replay has no such bound and returns every
window, the last one included.

Event-time windows only close when newer rows arrive.  ``closing_word_count`` has
processing-time windows instead, which close by a timer: the last window of a
stream that falls silent is emitted, too, and its state removed.
"""

from __future__ import annotations

import time
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import jvm_split
from ..session import checkpoint_dir, cut_lineage
from ..sources.sinks import remove_path


def ntz_as_utc_instant(c):
    """A ``timestamp_ntz`` wall clock read as UTC, as an event-time
    ``timestamp`` (watermarks need that type) -- independent of the session
    time zone."""
    col = F.col(c) if isinstance(c, str) else c
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), col).cast("timestamp")


def instant_as_utc_ntz(c):
    """Inverse of ``ntz_as_utc_instant``: the UTC wall clock of an instant."""
    col = F.col(c) if isinstance(c, str) else c
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col.cast("timestamp_ntz"))


def with_processing_time(lines: DataFrame, col: str = "ts") -> DataFrame:
    """STM-02: stamp each row with the processing (micro-batch) time."""
    return lines.withColumn(col, F.current_timestamp())


def words(lines: DataFrame, value: str = "value", sep: str = "\\s", keep=("ts",)) -> DataFrame:
    """GEN-05: one row per word, JVM split on the regex ``sep``."""
    return lines.select(*keep, F.explode(jvm_split(F.col(value), sep, regex=True)).alias("word"))


def tumbling_word_count(word_rows: DataFrame, ts: str, window: str, lateness: str | None,
                        keep_window: bool = True) -> DataFrame:
    """STM-01/03: count per (tumbling window, word).

    ``lateness``: how much older than the newest row a row may be; older ones
    are dropped, and append mode emits a window once, when it can get no more
    rows.  None (for a bounded ``replay``): no row is too late, every window
    stays open.  ``keep_window=False`` drops the window bounds."""
    rows = word_rows if lateness is None else word_rows.withWatermark(ts, lateness)
    agg = (rows.groupBy(F.window(ts, window).alias("w"), "word")
           .agg(F.count(F.lit(1)).alias("count")))
    cols = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")] if keep_window else []
    return agg.select(*cols, "word", "count")


def _counted(batches):
    """Words -> (word, n) of each Arrow batch: a frequent word is one row of a batch."""
    for b in batches:
        if b.num_rows:
            found = pa.table([b.column(0)], names=["word"]).group_by("word").aggregate([([], "count_all")])
            yield from found.select(["word", "count_all"]).rename_columns(["word", "n"]).to_batches()


def closing_word_count(word_rows: DataFrame, seconds: float) -> DataFrame:
    """STM-02/03: ``(word, window_start, window_end, count)`` of a stream of words, one row
    per word and processing-time window of ``seconds``, emitted once when the window
    has passed, whether or not another row arrives.

    A word's state is its open window and count; a processing-time timer stands at
    the window's end.  A row that comes later closes the old window itself."""
    size = int(seconds * 1000)
    schema = "word string, window_start timestamp, window_end timestamp, count bigint"

    def row(key, start: int, n: int) -> pd.DataFrame:
        bounds = [pd.Timestamp(x, unit="ms") for x in (start, start + size)]
        return pd.DataFrame({"word": [key[0]], "window_start": bounds[:1], "window_end": bounds[1:], "count": [n]})

    def step(key, batches, state):
        if state.hasTimedOut:
            start, n = state.get
            state.remove()
            yield row(key, start, n)
            return
        now = state.getCurrentProcessingTimeMs()
        here, n = now - now % size, sum(int(b["n"].sum()) for b in batches)
        if state.exists:
            start, before = state.get
            if start == here:
                n += before
            else:
                yield row(key, start, before)
        state.update((here, n))
        state.setTimeoutDuration(max(1, here + size - now))

    counts = word_rows.where(F.col("word").isNotNull()).select("word").mapInArrow(_counted, "word string, n bigint")
    return counts.groupBy("word").applyInPandasWithState(step, schema, "start bigint, n bigint", "append", "ProcessingTimeTimeout")


def run_until_closed(stream: DataFrame, name: str, every: str = "1 second", patience: float = 600,
                     state_partitions: int | None = None) -> DataFrame:
    """Run a stream of closing windows until all that its source had is read and no
    window is open, and return the emitted rows, checkpointed."""
    spark = stream.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"
    conf = "spark.sql.shuffle.partitions"
    old = spark.conf.get(conf)
    if state_partitions:
        spark.conf.set(conf, str(state_partitions))
    try:
        q = (stream.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/state").trigger(processingTime=every).start())
    finally:
        spark.conf.set(conf, old)
    until = time.monotonic() + patience
    try:
        while not _closed(q):
            if q.exception() is not None:
                raise q.exception()
            if time.monotonic() > until:
                raise TimeoutError(f"windows of {name} are still open after {patience} s")
            time.sleep(0.2)
    finally:
        q.stop()
    out = cut_lineage(spark.read.schema(_ddl(stream)).parquet(f"{base}/out"))
    remove_path(spark, base)
    return out


def _closed(q) -> bool:
    """Whether the last batch read nothing and left no state."""
    p = q.lastProgress
    return bool(p) and p["batchId"] > 0 and p["numInputRows"] == 0 and sum(s["numRowsTotal"] for s in p["stateOperators"]) == 0


def run_available(stream: DataFrame, mode: str = "append", name: str | None = None,
                  out_dir: str | None = None, state_partitions: int | None = None) -> DataFrame:
    """Run a streaming DataFrame over all available input (availableNow) into
    a parquet sink in the shared checkpoint folder and return the result as
    a batch DataFrame (nothing passes through the driver).

    ``state_partitions`` fixes the number of state-store partitions of this
    query (a streaming aggregation keeps one store per shuffle partition and
    AQE does not coalesce them); the stream clones the session settings when
    it starts, so the session's own value is restored right after."""
    spark = stream.sparkSession
    base = out_dir or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name or 'stream'}-{uuid.uuid4().hex}"
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    if state_partitions:
        spark.conf.set(key, str(state_partitions))
    try:
        q = (stream.writeStream.format("parquet").outputMode(mode)
             .option("path", f"{base}/out").option("checkpointLocation", f"{base}/chk")
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set(key, old)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(f"{base}/out")


def replay(counts: DataFrame, keys: list[str], name: str, state_partitions: int | None = None) -> DataFrame:
    """Run a streaming aggregate over all available input and return its final
    rows, those of windows that are still open included.

    Each micro-batch appends the groups it changed, with its number, to a folder
    in the shared checkpoint folder; the last number wins per key.  The result is
    checkpointed and the folder removed."""
    spark = counts.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"
    conf = "spark.sql.shuffle.partitions"
    old = spark.conf.get(conf)
    if state_partitions:
        spark.conf.set(conf, str(state_partitions))

    def put(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{base}/out/{number}")

    try:
        q = (counts.writeStream.outputMode("update").foreachBatch(put)
             .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start())
    finally:
        spark.conf.set(conf, old)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    rest = [c for c in counts.columns if c not in keys]
    changes = spark.read.schema(f"{_ddl(counts)}, _batch int").option("recursiveFileLookup", "true").parquet(f"{base}/out")
    last = changes.groupBy(*keys).agg(*[F.max_by(c, "_batch").alias(c) for c in rest])
    out = cut_lineage(last.select(*counts.columns))
    remove_path(spark, base)
    return out


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def log_record_stream(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """STM-04: a text-file stream as ``(topic, key, value)`` records (line
    numbers exist only in the batch form, so the key is NULL)."""
    lines = spark.readStream.format("text").load(path)
    return lines.select(F.lit(topic).alias("topic"), F.lit(None).cast("string").alias("key"),
                        F.col("value").alias("value"))
