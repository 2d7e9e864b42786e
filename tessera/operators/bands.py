"""Band join (JOI-13): rows meet every band that holds their value.

A band of width w is laid on cells of the smallest power of two that is no smaller
than w, so it touches two cells at most.  A row is in one cell of each size in use;
rows and bands meet by (size, cell) -- an equality, which Spark hashes, broadcasts
if small, or splits if skewed -- and the bounds are tested exactly afterwards.
Without this, a join by BETWEEN compares each row with each band.

Rows of a join that is only summed by band (``sums``) are not made one by one, as many
as rows times overlapping bands: the values and the bands' ends are numbered in order, so
a band holds the numbers between its ends, and these are put together from sums over
1, 2, 4, ... numbers, at most two of a size.  Only sums are added, none are subtracted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.sinks import global_row_number

_PRECISE = 50  # cells of a size are numbered within 2^52


def band_join(rows: DataFrame, bands: DataFrame, value: str, lo: str, hi: str, sums: Sequence[str] | None = None,
              count: str = "n") -> DataFrame:
    """``rows JOIN bands ON value BETWEEN lo AND hi``: the columns of both; overlapping
    bands give several rows.  Numbers are compared as doubles.  NULL, NaN and
    empty bands (``hi`` below ``lo``) match nothing.  The sizes in use, at most one
    for each power of two of the widths, are listed on the driver.  With ``sums``: each
    band that meets any row once, with their ``count`` and the sums of these columns."""
    x = F.col(value).cast("double")
    low, high = F.col(lo).cast("double"), F.col(hi).cast("double")
    sound = bands.where((low <= high) & ~F.isnan(high) & ~F.isnan(low) & (F.abs(low) < math.inf) & (F.abs(high) < math.inf))
    if sums is not None:
        return _summed(rows, sound, x, low, high, sums, count)
    width, reach = F.greatest(high - low, F.lit(2.0**-1000)), F.greatest(F.abs(low), F.abs(high), F.lit(2.0**-900))
    # no smaller than the numbers' own precision, so that cell numbers stay exact
    size = F.greatest(F.ceil(F.log2(width)), F.ceil(F.log2(reach)) - _PRECISE).cast("int")
    sized = sound.withColumn("_size", size)
    used = sized.groupBy("_size").agg(F.min(low).alias("lo"), F.max(high).alias("hi")).collect()
    if not used:
        return rows.join(sized.drop("_size"), F.lit(False))

    def cell(number, size_):
        return F.floor(number / F.pow(F.lit(2.0), size_)).cast("bigint")

    cells = sized.withColumn("_cell", F.explode(F.sequence(cell(low, F.col("_size")), cell(high, F.col("_size")))))
    sizes = F.array(*[F.struct(F.lit(r["_size"]).alias("size"), F.lit(float(r["lo"])).alias("lo"), F.lit(float(r["hi"])).alias("hi")) for r in used])
    mine = rows.withColumn("_of", F.explode(F.filter(sizes, lambda s: (x >= s["lo"]) & (x <= s["hi"]))))
    mine = mine.withColumn("_size", F.col("_of.size")).withColumn("_cell", cell(x, F.col("_size"))).drop("_of")
    met = mine.join(cells, ["_size", "_cell"]).where((x >= low) & (x <= high))
    return met.drop("_size", "_cell")


def _summed(rows: DataFrame, bands: DataFrame, x, low, high, sums: Sequence[str], count: str) -> DataFrame:
    least, most = bands.agg(F.min(low), F.max(high)).first()

    def added(cells: DataFrame, *by) -> DataFrame:
        return cells.groupBy(*by).agg(F.sum("_n").alias("_n"), *[F.sum(c).alias(c) for c in held])

    held = [f"_sum{i}" for i in range(len(sums))]
    near = rows.where((x >= F.lit(least)) & (x <= F.lit(most)))  # no bands: NULL, no rows
    values = added(near.select((x + 0.0).alias("_x"), F.lit(1).alias("_n"), *[F.col(c).alias(h) for c, h in zip(sums, held)]), "_x")
    ends = [bands.select((end + 0.0).alias("_x")).distinct().withColumn("_kind", F.lit(kind)) for kind, end in ((0, low), (2, high))]
    marks = values.withColumn("_kind", F.lit(1))
    for end in ends:  # of equal numbers lower ends come first, upper ends last
        marks = marks.unionByName(end, allowMissingColumns=True)
    marks = global_row_number(marks, ["_x", "_kind"], out="_at")
    # the numbers of a band: from _a, below _b
    lows = marks.where("_kind = 0").select(F.col("_x").alias("_lo"), (F.col("_at") + 1).alias("_a"))
    highs = marks.where("_kind = 2").select(F.col("_x").alias("_hi"), F.col("_at").alias("_b"))
    placed = bands.withColumn("_lo", low + 0.0).withColumn("_hi", high + 0.0).join(lows, "_lo").join(highs, "_hi").drop("_lo", "_hi")
    placed = cut_lineage(placed.where("_a < _b"))
    spans = placed.select("_a", "_b").distinct()
    top = (placed.agg(F.max(F.col("_b") - F.col("_a"))).first()[0] or 1).bit_length()
    # cell c of level j: numbers c 2^j to (c + 1) 2^j - 1
    cells = marks.where("_kind = 1").withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(top - 1))))
    cells = cut_lineage(added(cells.withColumn("_cell", F.expr("shiftright(_at, _level)")), "_level", "_cell"))
    first, end = "shiftright(_a + shiftleft(1L, {0}) - 1, {0})", "shiftright(_b, {0})"
    parts = spans.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(top - 1))))
    parts = parts.where(f"{first.format('(_level + 1)')} <= {end.format('(_level + 1)')}")
    parts = parts.withColumn("_first", F.expr(first.format("_level"))).withColumn("_end", F.expr(end.format("_level")))
    parts = parts.withColumn("_cell", F.explode(F.expr(
        "filter(array(if(_first % 2 = 1, _first, null), if(_end % 2 = 1, _end - 1, null)), c -> c is not null)")))
    totals = cut_lineage(added(parts.drop("_first", "_end").join(cells, ["_level", "_cell"]), "_a", "_b"))
    met = placed.join(totals, ["_a", "_b"])
    return met.select(*bands.columns, F.col("_n").alias(count), *[F.col(h).alias(c) for c, h in zip(sums, held)])
