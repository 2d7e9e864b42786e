"""Sinks and table maintenance (SNK-01 .. SNK-06, TBL-01 .. TBL-07)."""

from __future__ import annotations

import contextlib
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import small
from ..session import cut_lineage

BARS_COLUMNS = ["t_date", "open_pr", "high_pr", "low_pr", "close_pr", "adj_close_pr", "volume", "symbol"]
BARS_DDL = ("t_date int, open_pr double, high_pr double, low_pr double, close_pr double, "
            "adj_close_pr double, volume bigint, symbol string")


def _conform_to_table(df: DataFrame, table: str) -> DataFrame:
    """insertInto is positional: reorder by the table's column names first."""
    cols = df.sparkSession.table(table).columns
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for {table}: {missing}")
    return df.select(*cols)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """SNK-01: dynamic partition overwrite -- only partitions present in
    ``df`` are replaced."""
    df.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    _conform_to_table(df, table).write.mode("overwrite").insertInto(table)


def append_partition(df: DataFrame, table: str, partition_col: str = "date_p",
                     fail_if_partition_exists: bool = False) -> None:
    """SNK-02: insert into an existing partitioned table without overwrite.

    With ``fail_if_partition_exists`` the insert is refused when any target
    partition already holds rows (a semi join on the partition values, not a
    collect of the data)."""
    if fail_if_partition_exists:
        existing = df.sparkSession.table(table).select(partition_col).distinct()
        clash = df.select(partition_col).distinct().join(existing, partition_col, "left_semi")
        if clash.limit(1).count() > 0:
            raise ValueError(f"partition already exists in {table}")
    _conform_to_table(df, table).write.insertInto(table, overwrite=False)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through Spark's file system layer."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-03: one text line per row (single string column) or CSV otherwise."""
    if len(df.columns) == 1:
        df.select(F.col(df.columns[0]).cast("string")).write.mode(mode).text(path)
    else:
        df.write.mode(mode).csv(path)


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """SNK-04: bounded preview (ordered when an order is given; Spark rows
    have no inherent order)."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def stream_out(df: DataFrame, fmt: str = "memory", mode: str = "append", query_name: str | None = None,
               checkpoint: str | None = None, trigger: dict | None = None, **options):
    """SNK-05: start a streaming sink (``console`` or ``memory`` for tests)."""
    w = df.writeStream.format(fmt).outputMode(mode)
    if query_name:
        w = w.queryName(query_name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    for k, v in options.items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def global_row_number(df: DataFrame, order_cols: Sequence[str], out: str = "row_no",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based row number over a total order without a single-partition window.

    Range-partition on the order, sort within partitions, number rows locally
    (``monotonically_increasing_id`` encodes partition and position), count
    rows per partition (a tiny aggregate, one row per partition), turn the
    counts into offsets, and add them back with a broadcast join whose size is
    bounded by the number of partitions.  ``order_cols`` must be unique.
    """
    # Without an explicit count AQE may merge adjacent range partitions (their
    # order is kept), so small inputs do not pay for hundreds of tiny tasks.
    ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols))
    ranged = (ranged.sortWithinPartitions(*order_cols)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = (ranged.withColumn("_pid", F.shiftright("_mid", 33))
                    .withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid"), 33) + 1))
    # Range boundaries come from a sample that is redrawn on every evaluation,
    # so the numbered rows are materialised once before counting.
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(out, F.col("_off") + F.col("_local"))
                  .drop("_mid", "_pid", "_local", "_off"))


def to_log_records(lines: DataFrame, topic: str, line_no: str = "line_no", value: str = "value",
                   skip_header: bool = True) -> DataFrame:
    """SNK-06: numbered lines -> ``(topic, key, value)`` records.  The key is
    the 1-based line number as text, so after dropping the header the first
    record has key ``"2"``."""
    df = lines.where(F.col(line_no) > 1) if skip_header else lines
    return df.select(F.lit(topic).alias("topic"), F.col(line_no).cast("string").alias("key"),
                     F.col(value).cast("string").alias("value"))


def number_text_lines(lines: DataFrame) -> DataFrame:
    """Line numbers for ``spark.read.text`` output, in file order: order by
    (file, split start, position inside the split)."""
    df = lines.select("value", F.col("_metadata.file_path").alias("_f"),
                      F.col("_metadata.file_block_start").alias("_b"),
                      F.monotonically_increasing_id().alias("_m"))
    return global_row_number(df, ["_f", "_b", "_m"], out="line_no").drop("_f", "_b", "_m")


def write_log_records(records: DataFrame, bootstrap_servers: str, **producer_options) -> None:
    """SNK-06 sink: Kafka (needs the spark-sql-kafka package on the cluster).
    Producer settings pass through as ``kafka.*`` options."""
    w = records.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    for k, v in producer_options.items():
        w = w.option(f"kafka.{k}", str(v))
    w.save()


# ------------------------------------------------------------ bars tables ---

def create_bars_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """TBL-01: drop and create the bars table, partitioned by symbol."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} ({BARS_DDL}) USING parquet PARTITIONED BY (symbol){loc}")


def append_bars(df: DataFrame, name: str) -> None:
    """TBL-02: bulk append."""
    _conform_to_table(df, name).write.insertInto(name, overwrite=False)


def insert_ignore(existing: DataFrame, new: DataFrame, keys: Sequence[str],
                  order_by: Sequence[str] | None = None) -> DataFrame:
    """TBL-03: rows of ``new`` whose key is not in ``existing``; within the
    batch the first row per key (by ``order_by``) wins.

    Returns the rows to append.  Keep-first is a ``min_by`` aggregate (map-side
    pre-aggregated, so a key repeated a million times in the batch is not
    sorted in one task), then a left-anti join on the keys.
    """
    cols = [c for c in new.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in (order_by or cols)])
    firsts = (new.groupBy(*keys)
                 .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_r"))
                 .select(*keys, *[F.col("_r")[c].alias(c) for c in cols]))
    return firsts.join(existing.select(*keys), list(keys), "left_anti").select(*new.columns)


def insert_ignore_into(spark: SparkSession, name: str, new: DataFrame, keys: Sequence[str],
                       order_by: Sequence[str] | None = None) -> DataFrame:
    """TBL-03 on a stored table: the rows of ``new`` to append to ``name``, as of
    ``insert_ignore``.  The batch's keys go to the table, not the table to the batch:
    only partitions that the batch names are read (up to ``_NAMED`` of them are listed;
    beyond that, all), and keys within the broadcast bound are sent to the scan, so
    nothing of the table is shuffled; what comes back is no larger than the batch.
    A larger batch meets the table by shuffle."""
    cols = [c for c in new.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in (order_by or cols)])
    firsts = cut_lineage(new.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_r"))
                         .select(*keys, *[F.col("_r")[c].alias(c) for c in cols]))
    met = cut_lineage(_touched(spark, name, firsts, keys).distinct())
    return firsts.join(met, list(keys), "left_anti").select(*new.columns)


_NAMED = 10_000


def _touched(spark: SparkSession, name: str, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of the table ``name`` that are among those of ``batch``."""
    table = spark.table(name).select(*keys)
    for c in (c.name for c in spark.catalog.listColumns(name) if c.isPartition and c.name in keys):
        values = [r[0] for r in batch.select(c).distinct().limit(_NAMED + 1).collect()]
        if len(values) <= _NAMED:
            table = table.where(F.col(c).isin([v for v in values if v is not None]))
    return table.join(small(batch.select(*keys), batch.count(), 64 * len(keys)), list(keys))


def read_bars(spark: SparkSession, name: str, start=None, end=None, symbols: Sequence[str] | None = None) -> DataFrame:
    """TBL-04/05: inclusive date-range read (pushed to the scan / partition
    pruning on symbol)."""
    df = spark.table(name)
    if start is not None:
        df = df.where(F.col("t_date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("t_date") <= F.lit(end))
    if symbols:
        df = df.where(F.col("symbol").isin(list(symbols)))
    return df


@contextlib.contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """TBL-06: persist for the duration of a block (for inputs read twice)."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
