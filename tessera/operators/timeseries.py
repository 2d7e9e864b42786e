"""Price-bar indicators and signals (WIN-01 .. WIN-06, TS-01 .. TS-09).

All symbols are processed in one plan with windows partitioned by symbol and
ordered by the bar time.  A window partition holds one symbol's bars, whose
count is bounded by the number of bar periods in the loaded range (days or
hours), not by the data volume: more data means more symbols, each still a
short series.  Where a symbol has a long one (ticks, years of seconds),
``chunk_rows`` cuts the series of all symbols into chunks of that many rows, each
with the ``PRICE_WINDOW`` rows before it, so that no task sorts a whole symbol; the
result is the same.  The panic threshold (a mean over the whole loaded range of a
symbol) is a ``groupBy`` aggregate joined back, so it is partially
aggregated.

pandas semantics kept: a rolling mean needs a full frame of non-null values
(``min_periods = window``); comparisons with a missing operand are False;
``pct_change`` is ``x / x.shift(k) - 1``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.sinks import global_row_number

# Fixed values of the signal rules.
REVERSAL_A = {"body_low": 0.45, "close_above_low": 0.01}
REVERSAL_B = {"body_low": 0.5, "upper_shadow": 0.2, "amplitude": 0.8}
PANIC_FACTOR = 3.3
VOL_WINDOW = 15
PRICE_WINDOW = 60
AMP_WINDOW = 15
PANIC_LAG = 4  # the column is named "3 day" volatility but looks 4 rows back


def _w(key: str | Sequence[str], order: str) -> Window:
    return Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(order)


def in_chunks(bars: DataFrame, key: str, order: str, rows: int, halo: int = PRICE_WINDOW) -> DataFrame:
    """``bars`` with ``_chunk``, and copies (``_halo``) of the ``halo`` rows before each
    chunk.  Rows are numbered by (key, order) in ranges, so one key may hold any share."""
    at = F.col("_rn") - 1
    chunk = F.floor(at / rows)
    own = F.struct(chunk.alias("chunk"), F.lit(False).alias("halo"))
    ahead = F.filter(F.transform(F.sequence(F.lit(1), F.lit(-(-halo // rows))), lambda k: F.struct((chunk + k).alias("chunk"), F.lit(True).alias("halo"))),
                     lambda c: at >= c["chunk"] * rows - halo)
    numbered = global_row_number(bars, [key, order], out="_rn")
    return (numbered.withColumn("_c", F.explode(F.concat(F.array(own), ahead)))
            .withColumn("_chunk", F.col("_c.chunk")).withColumn("_halo", F.col("_c.halo")).drop("_c", "_rn"))


def rolling_mean(c: Column, w: Window, n: int) -> Column:
    """WIN-04: mean of the last ``n`` rows, NULL until ``n`` non-null values
    are in the frame."""
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(c).over(frame) == n, F.avg(c).over(frame))


def pct_change(c: Column, w: Window, k: int = 1) -> Column:
    """WIN-02/03: ``c / lag(c, k) - 1`` (NULL when undefined)."""
    return F.try_subtract(F.try_divide(c, F.lag(c, k).over(w)), F.lit(1.0))


def bars_from_ticks(ticks: DataFrame, symbol: str, ts: str, price: str, tie: str,
                    period: str = "hour") -> DataFrame:
    """OHLCV bars from ticks: open/close = price at the first/last
    ``(ts, tie)`` of the period, high/low = max/min, volume = tick count."""
    order = F.struct(F.col(ts), F.col(tie))
    return (ticks.groupBy(F.col(symbol).alias("symbol"), F.date_trunc(period, ts).alias("t"))
                 .agg(F.min_by(price, order).alias("open_pr"), F.max(price).alias("high_pr"),
                      F.min(price).alias("low_pr"), F.max_by(price, order).alias("close_pr"),
                      F.count(F.lit(1)).alias("volume")))


PRICE_COLUMNS = ("open_pr", "high_pr", "low_pr", "close_pr")


def nan_to_null(df: DataFrame, cols=PRICE_COLUMNS) -> DataFrame:
    """Q14: NaN prices become NULL, so comparisons with them are missing
    (False after the flag coalesce), as in pandas; Spark would otherwise
    order NaN above every number."""
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(F.col(c))
                           for c in cols if c in df.columns})


def add_indicators(bars: DataFrame, key: str = "symbol", order: str = "t", chunk_rows: int | None = None) -> DataFrame:
    """TS-01/02/04 + WIN-01/03: lags, volatility, rolling means, amplitude.
    ``chunk_rows``: see the module; (key, order) must then be unique."""
    if chunk_rows:
        cut = _indicators(in_chunks(nan_to_null(bars), key, order, chunk_rows), [key, "_chunk"], order)
        return cut.where(~F.col("_halo")).drop("_chunk", "_halo")
    return _indicators(nan_to_null(bars), [key], order)


def _indicators(bars: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    w = _w(keys, order)
    c = F.col("close_pr")
    vol = F.abs(pct_change(c, w, 1))
    amp = F.try_divide(F.col("high_pr") - F.col("low_pr"), F.col("open_pr"))
    return (bars
            .withColumn("c1", F.lag(c, 1).over(w))
            .withColumn("c2", F.lag(c, 2).over(w))
            .withColumn("day_volatility", vol)
            .withColumn("vol4", F.abs(pct_change(c, w, PANIC_LAG)))
            .withColumn("amplitude", amp)
            .withColumn("avg_volatility", rolling_mean(F.col("day_volatility"), w, VOL_WINDOW))
            .withColumn("avg_price", rolling_mean(c, w, PRICE_WINDOW))
            .withColumn("avg_amplitude", rolling_mean(F.col("amplitude"), w, AMP_WINDOW)))


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def reversal_a(ind: DataFrame) -> Column:
    """TS-03 rule A."""
    o, h, lo_, c = (F.col(x) for x in ("open_pr", "high_pr", "low_pr", "close_pr"))
    body_low = F.least(o, c)
    return _flag((o < F.col("c1")) & (F.col("c1") < F.col("c2")) & (c < F.col("avg_price"))
                 & (body_low - lo_ >= REVERSAL_A["body_low"] * (h - lo_))
                 & (c - lo_ > REVERSAL_A["close_above_low"] * o))


def reversal_b(ind: DataFrame) -> Column:
    """TS-05 rule B."""
    o, h, lo_, c = (F.col(x) for x in ("open_pr", "high_pr", "low_pr", "close_pr"))
    rng = h - lo_
    return _flag((o < F.col("c2")) & (F.least(o, c) - lo_ >= REVERSAL_B["body_low"] * rng)
                 & (h - F.greatest(o, c) <= REVERSAL_B["upper_shadow"] * rng)
                 & (F.col("amplitude") > REVERSAL_B["amplitude"] * F.col("avg_amplitude")))


def signals(bars: DataFrame, key: str = "symbol", order: str = "t", chunk_rows: int | None = None) -> DataFrame:
    """TS-07: indicators plus the three flags for every symbol in one pass.

    ``panic_threshold`` = 3.3 x the mean of the rolling volatility over the
    symbol's loaded range (a grouped aggregate joined back)."""
    ind = add_indicators(bars, key, order, chunk_rows)
    if chunk_rows:
        ind = cut_lineage(ind)  # read by the mean and by the flags
    mean_vol = ind.groupBy(key).agg(F.avg("avg_volatility").alias("mean_volatility"))
    ind = ind.join(mean_vol, key)
    c = F.col("close_pr")
    panic = _flag((c < F.col("c1")) & (F.col("c1") < F.col("c2"))
                  & (F.col("vol4") >= PANIC_FACTOR * F.col("mean_volatility")))
    return (ind.withColumn("reversal_a", reversal_a(ind))
               .withColumn("reversal_b", reversal_b(ind))
               .withColumn("panic_sell", panic))


def recent(df: DataFrame, as_of, days: int, order: str = "t") -> DataFrame:
    """FLT-12: rows with ``as_of - days <= t <= as_of`` (``as_of`` explicit)."""
    end = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else F.lit(as_of)
    return df.where((F.col(order) >= end - F.make_dt_interval(F.lit(days))) & (F.col(order) <= end))


def last_n(df: DataFrame, n: int, key: str = "symbol", order: str = "t") -> DataFrame:
    """WIN-06: the last ``n`` rows per key."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def signal_text(df: DataFrame, key: str = "symbol", order: str = "t", label_fmt: str = "yyyy-MM-dd",
                out: str = "msg") -> DataFrame:
    """STR-09 / AGG-29: ``label(price$)`` entries in time order joined by
    ``,\\n`` (price rounded to 2 decimals)."""
    entry = F.concat(F.date_format(order, label_fmt), F.lit("("), F.round("close_pr", 2).cast("string"), F.lit("$)"))
    return (df.groupBy(key)
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), entry.alias("e")))),
                                            lambda x: x["e"]), ",\n").alias(out)))


def signal_report(sig: DataFrame, as_of, days: int = 30, n: int = 2, reversal: str = "reversal_b",
                  key: str = "symbol", order: str = "t", label_fmt: str = "yyyy-MM-dd") -> DataFrame:
    """TS-09: per symbol the last ``n`` panic-sell and reversal signals in the
    last ``days`` days, as text (empty text when there is none).  Entries are
    ``<date>(<close rounded to 2>$)``; ``label_fmt`` formats the bar time
    (daily bars by default, e.g. ``yyyy-MM-dd HH:mm`` for hourly bars)."""
    rec = recent(sig, as_of, days, order)
    symbols = sig.select(key).distinct()
    panic = signal_text(last_n(rec.where("panic_sell"), n, key, order), key, order, label_fmt, out="panic_sell")
    rev = signal_text(last_n(rec.where(F.col(reversal)), n, key, order), key, order, label_fmt, out="reversal")
    return (symbols.join(panic, key, "left").join(rev, key, "left")
                   .select(key, F.coalesce("panic_sell", F.lit("")).alias("panic_sell"),
                           F.coalesce("reversal", F.lit("")).alias("reversal")))


def recent_alerts(sig: DataFrame, flag: str, as_of, days: int = 8, key: str = "symbol",
                  order: str = "t") -> DataFrame:
    """TS-08: count of alerts in the last ``days`` days and their times/closes."""
    rec = recent(sig, as_of, days, order).where(F.col(flag))
    return rec.groupBy(key).agg(F.count(F.lit(1)).alias("alerts"),
                                F.array_sort(F.collect_list(F.struct(order, "close_pr"))).alias("points"))
