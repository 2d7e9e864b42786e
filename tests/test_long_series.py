"""Indicators over chunks of long series equal those over whole series."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import timeseries as TS


def bars(spark, seed=1):
    rng = random.Random(seed)
    rows = []
    for symbol, n in (("hot", 900), ("b", 61), ("c", 60), ("d", 3)):  # one symbol holds 88 % of the rows
        price = 100.0
        for i in range(n):
            price *= 1 + rng.uniform(-0.03, 0.03)
            close = None if rng.random() < 0.01 else price * (1 + rng.uniform(-0.02, 0.02))
            rows.append((symbol, i * 3, price, price * 1.03, price * 0.97, close, 1))
    return spark.createDataFrame(rows, "symbol string, t int, open_pr double, high_pr double, low_pr double, close_pr double, volume int").repartition(7)


@pytest.mark.parametrize("rows", [1, 17, 60, 100, 5000])
def test_chunks_give_the_same(spark, rows):
    df = bars(spark)
    names = TS.signals(df).columns

    def table(sig):
        out = sig.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in sig.select(*names).dtypes]).collect()
        return sorted((tuple(r) for r in out), key=lambda r: (r[names.index("symbol")], r[names.index("t")]))

    assert table(TS.signals(df, chunk_rows=rows)) == table(TS.signals(df))


def test_no_chunk_holds_a_whole_symbol(spark):
    cut = TS.in_chunks(bars(spark), "symbol", "t", 50)
    sizes = [r["n"] for r in cut.groupBy("symbol", "_chunk").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 50 + TS.PRICE_WINDOW
    assert cut.where(~F.col("_halo")).count() == 900 + 61 + 60 + 3
