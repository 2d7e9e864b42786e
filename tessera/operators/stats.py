"""Distribution statistics and sorts (AGG-19 .. AGG-25, SRT-01 .. SRT-05,
FLT-07/08, MTH-03).

Exact percentiles (linear interpolation, the numpy/pandas default) are
computed from a distributed rank: the data is range-partitioned on (group,
value), per-partition counts tell where the two ranks around each requested
position lie, and only those partitions are ranked.  No group's values are ever collected into one buffer, which
the built-in exact ``percentile`` aggregate would do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clip_upper
from ..session import cut_lineage
from ..sources.sinks import global_row_number


def value_counts(df: DataFrame, cols: str | Sequence[str], name: str = "count") -> DataFrame:
    """AGG-19/20: counts per value (combination), most frequent first."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *[F.asc(c) for c in cols])


def min_max_count(df: DataFrame, col: str) -> DataFrame:
    """AGG-21."""
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"), F.count(F.lit(1)).alias("rows"),
                  F.count(col).alias("non_null"))


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation: ``(group..., q, value)``.

    Equal values are folded first (partial aggregation).  One range exchange on
    (group, value) then fixes which partition holds which ranks: the row counts
    of each (group, partition) tell, for every requested rank, the one partition
    to look in.  Only those partitions are ranked inside, each on its own."""
    g = list(group_cols) or ["_g"]
    src = df if group_cols else df.withColumn("_g", F.lit(0))
    folded = src.where(F.col(col).isNotNull()).groupBy(*g, F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ranged = cut_lineage(folded.repartitionByRange(*g, "_v").withColumn("_pid", F.spark_partition_id()))
    # at most (partitions + groups) rows; a group's windows see at most one row per partition
    parts = cut_lineage(ranged.groupBy(*g, "_pid").agg(F.sum("_c").alias("_n")))
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("_off", F.sum("_n").over(before) - F.col("_n")).withColumn("_all", F.sum("_n").over(Window.partitionBy(*g)))
    at = parts.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs]))).withColumn("_p", (F.col("_all") - 1) * F.col("q"))
    at = at.withColumn("_r", F.explode(F.array(F.floor("_p"), F.ceil("_p"))))
    at = at.where((F.col("_r") >= F.col("_off")) & (F.col("_r") < F.col("_off") + F.col("_n")))
    wanted = cut_lineage(at.select(*g, "_pid", "q", "_p", "_r", (F.col("_r") - F.col("_off")).alias("_k")).distinct())
    inside = ranged.join(wanted.select(*g, "_pid").distinct(), [*g, "_pid"], "left_semi")
    run = Window.partitionBy(*g, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("_hi", F.sum("_c").over(run)).withColumn("_lo", F.col("_hi") - F.col("_c"))
    found = ranked.join(wanted, [*g, "_pid"]).where((F.col("_lo") <= F.col("_k")) & (F.col("_k") < F.col("_hi")))
    # the values at the ranks below and above the position; one and the same if it is whole
    ends = found.groupBy(*g, "q", "_p").agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    return ends.select(*list(group_cols), "q", (F.col("_a") + (F.col("_p") - F.floor("_p")) * (F.col("_b") - F.col("_a"))).alias("value"))


def quantile_value(df: DataFrame, col: str, q: float) -> float | None:
    """One exact quantile as a Python number (one row reaches the driver)."""
    row = exact_quantiles(df, col, [q]).first()
    return None if row is None else row["value"]


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-23: long-form describe, one row per column: count, mean, std
    (sample), min, 25%, 50%, 75%, max (exact quantiles).

    The columns are stacked into ``(column, v)`` rows first, so all columns
    share one aggregate and one distributed ranking."""
    long = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                          for c in cols])).alias("s"))
              .select("s.column", "s.v"))
    base = long.groupBy("column").agg(F.count("v").alias("count"), F.avg("v").alias("mean"),
                                      F.stddev_samp("v").alias("std"), F.min("v").alias("min"),
                                      F.max("v").alias("max"))
    qs = exact_quantiles(long, "v", [0.25, 0.5, 0.75], ["column"])
    piv = qs.groupBy("column").agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n)
                                     for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return base.join(piv, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75",
                                                   "max")


def five_number(df: DataFrame, group_cols: str | Sequence[str], col: str) -> DataFrame:
    """AGG-25: grouped min, q1, median, q3, max (the data behind box plots)."""
    g = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    mm = df.groupBy(*g).agg(F.min(col).cast("double").alias("min"), F.max(col).cast("double").alias("max"))
    qs = exact_quantiles(df, col, [0.25, 0.5, 0.75], g)
    piv = qs.groupBy(*g).agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n)
                              for q, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    return mm.join(piv, g).select(*g, "min", "q1", "median", "q3", "max")


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """AGG-24: fixed-width histogram over [min, max] with the last bin closed,
    every bin listed (empty ones with 0): ``(bin, lo, hi, count)``."""
    spark = df.sparkSession
    lo_, hi_ = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    if lo_ is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, count bigint")
    if lo_ == hi_:
        lo_, hi_ = lo_ - 0.5, hi_ + 0.5
    width = (hi_ - lo_) / bins
    b = F.least(F.floor((F.col(col) - F.lit(lo_)) / F.lit(hi_ - lo_) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(counts, "bin", "left")
                    .select("bin", (F.lit(lo_) + F.col("bin") * F.lit(width)).alias("lo"),
                            (F.lit(lo_) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
                            F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def clip_at_quantile(df: DataFrame, col: str, q: float = 0.99, out: str | None = None) -> DataFrame:
    """MTH-03: clip a column at its exact ``q`` quantile (NULL stays NULL)."""
    bound = quantile_value(df, col, q)
    return df.withColumn(out or col, clip_upper(col, F.lit(bound)))


def dropna(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """FLT-08: drop rows with any NULL (NaN counts as missing, as pandas)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def isin(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """FLT-07."""
    return df.where(F.col(col).isin(list(values)))


def sort_with_rank(df: DataFrame, cols: Sequence[str], out: str = "row_no") -> DataFrame:
    """SRT-01/02: global ascending sort (range partitioning + external sort),
    with the 1-based position in the order as a column."""
    return global_row_number(df, list(cols), out=out)


def head(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """SRT-03: first ``n`` rows in a given order (top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(n)
