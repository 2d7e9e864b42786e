"""Signal queries bound to the driver tables.

Bars come from ``events``: symbol = event_type, one bar per hour, open/close
= value of the first/last event of the hour by (ts, event_id), high/low =
max/min value, volume = number of events (daily bars would give only 30 rows
per symbol, too few for the 60-row price mean).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import timeseries as TS
from ..session import cut_lineage
from ..sources import sinks
from ..sources.tables import Tables
from .common import r6, register

AS_OF = "2024-01-31 00:00:00"
REPORT_DAYS = 7
SPLIT_NEW_FROM = "2024-01-10 00:00:00"
SPLIT_OLD_BEFORE = "2024-01-20 00:00:00"


def bars(t: Tables) -> DataFrame:
    """The bars, built once: signals and updates read them several times."""
    return cut_lineage(TS.bars_from_ticks(t.events, "event_type", "ts", "value", "event_id", "hour"))


def _tfmt(c="t"):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias("t")


_BARS_SQL = """
bars AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS t,
         first(value ORDER BY ts, event_id) AS open_pr, max(value) AS high_pr, min(value) AS low_pr,
         last(value ORDER BY ts, event_id) AS close_pr, count(*) AS volume
  FROM events GROUP BY 1, 2)"""

_FLAGS_SQL = _BARS_SQL + """,
ind AS (
  SELECT *, lag(close_pr, 1) OVER w AS c1, lag(close_pr, 2) OVER w AS c2,
         abs(close_pr / lag(close_pr, 1) OVER w - 1) AS day_volatility,
         abs(close_pr / lag(close_pr, 4) OVER w - 1) AS vol4,
         (high_pr - low_pr) / open_pr AS amplitude
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY t)),
ind2 AS (
  SELECT *,
    CASE WHEN count(day_volatility) OVER w15 = 15 THEN avg(day_volatility) OVER w15 END AS avg_volatility,
    CASE WHEN count(close_pr) OVER w60 = 60 THEN avg(close_pr) OVER w60 END AS avg_price,
    CASE WHEN count(amplitude) OVER w15 = 15 THEN avg(amplitude) OVER w15 END AS avg_amplitude
  FROM ind WINDOW w15 AS (PARTITION BY symbol ORDER BY t ROWS BETWEEN 14 PRECEDING AND CURRENT ROW),
                  w60 AS (PARTITION BY symbol ORDER BY t ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)),
sig AS (SELECT *, avg(avg_volatility) OVER (PARTITION BY symbol) AS mean_volatility FROM ind2),
flags AS (
  SELECT *,
    coalesce(open_pr < c1 AND c1 < c2 AND close_pr < avg_price
             AND least(open_pr, close_pr) - low_pr >= 0.45 * (high_pr - low_pr)
             AND close_pr - low_pr > 0.01 * open_pr, false) AS reversal_a,
    coalesce(open_pr < c2 AND least(open_pr, close_pr) - low_pr >= 0.5 * (high_pr - low_pr)
             AND high_pr - greatest(open_pr, close_pr) <= 0.2 * (high_pr - low_pr)
             AND amplitude > 0.8 * avg_amplitude, false) AS reversal_b,
    coalesce(close_pr < c1 AND c1 < c2 AND vol4 >= 3.3 * mean_volatility, false) AS panic_sell
  FROM sig)"""


_INDICATORS_SQL = f"""
WITH {_FLAGS_SQL}
SELECT symbol, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, open_pr, high_pr, low_pr, close_pr, volume, c1, c2,
       round(day_volatility, 6) AS day_volatility, round(vol4, 6) AS vol4, round(amplitude, 6) AS amplitude,
       round(avg_volatility, 6) AS avg_volatility, round(avg_price, 6) AS avg_price,
       round(avg_amplitude, 6) AS avg_amplitude, round(mean_volatility, 6) AS mean_volatility,
       reversal_a, reversal_b, panic_sell
FROM flags
"""


@register("bar_indicators", _INDICATORS_SQL)
def bar_indicators(t: Tables) -> DataFrame:
    """TS-01/02/04/07 + WIN-01..05: every hourly bar with its indicators and flags."""
    return _indicators(TS.signals(bars(t)))


@register("bar_indicators_long", _INDICATORS_SQL)
def bar_indicators_long(t: Tables) -> DataFrame:
    """The same over chunks of 256 rows, as for symbols with long series."""
    return _indicators(TS.signals(bars(t), chunk_rows=256))


def _indicators(s: DataFrame) -> DataFrame:
    return s.select("symbol", _tfmt(), "open_pr", "high_pr", "low_pr", "close_pr", "volume", "c1", "c2",
                    *[r6(c).alias(c) for c in ("day_volatility", "vol4", "amplitude", "avg_volatility",
                                               "avg_price", "avg_amplitude", "mean_volatility")],
                    "reversal_a", "reversal_b", "panic_sell")


@register("ohlc_signals_a", f"""
WITH {_FLAGS_SQL}
SELECT symbol, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, close_pr, c1, c2, round(avg_price, 6) AS avg_price
FROM flags WHERE reversal_a
""")
def ohlc_signals_a(t: Tables) -> DataFrame:
    """TS-03: reversal rule A."""
    s = TS.signals(bars(t)).where("reversal_a")
    return s.select("symbol", _tfmt(), "close_pr", "c1", "c2", r6("avg_price").alias("avg_price"))


@register("ohlc_signals_b", f"""
WITH {_FLAGS_SQL}
SELECT symbol, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, close_pr, round(amplitude, 6) AS amplitude,
       round(avg_amplitude, 6) AS avg_amplitude
FROM flags WHERE reversal_b
""")
def ohlc_signals_b(t: Tables) -> DataFrame:
    """TS-05: reversal rule B."""
    s = TS.signals(bars(t)).where("reversal_b")
    return s.select("symbol", _tfmt(), "close_pr", r6("amplitude").alias("amplitude"),
                    r6("avg_amplitude").alias("avg_amplitude"))


@register("panic_sell", f"""
WITH {_FLAGS_SQL}
SELECT symbol, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, close_pr, round(vol4, 6) AS vol4,
       round(mean_volatility, 6) AS mean_volatility
FROM flags WHERE panic_sell
""")
def panic_sell(t: Tables) -> DataFrame:
    """TS-06: panic sell."""
    s = TS.signals(bars(t)).where("panic_sell")
    return s.select("symbol", _tfmt(), "close_pr", r6("vol4").alias("vol4"),
                    r6("mean_volatility").alias("mean_volatility"))


def _report_part(flag: str) -> str:
    return f"""(SELECT symbol, string_agg(strftime(t, '%Y-%m-%d %H:%M') || '(' || CAST(round(close_pr, 2) AS VARCHAR) || '$)',
                     ',' || chr(10) ORDER BY t) AS m
     FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY t DESC) AS rn FROM rec WHERE {flag})
     WHERE rn <= 2 GROUP BY symbol)"""


@register("signal_report", f"""
WITH {_FLAGS_SQL},
rec AS (SELECT * FROM flags WHERE t >= TIMESTAMP '{AS_OF}' - INTERVAL {REPORT_DAYS} DAY AND t <= TIMESTAMP '{AS_OF}'),
p AS {_report_part('panic_sell')},
r AS {_report_part('reversal_b')}
SELECT s.symbol, coalesce(p.m, '') AS panic_sell, coalesce(r.m, '') AS reversal
FROM (SELECT DISTINCT symbol FROM flags) s LEFT JOIN p ON p.symbol = s.symbol LEFT JOIN r ON r.symbol = s.symbol
""")
def signal_report(t: Tables) -> DataFrame:
    """TS-09: last two panic and reversal signals per symbol in the last 7 days."""
    return TS.signal_report(TS.signals(bars(t)), AS_OF, REPORT_DAYS, 2, label_fmt="yyyy-MM-dd HH:mm")


@register("recent_alerts", f"""
WITH {_FLAGS_SQL}
SELECT symbol, count(*) AS alerts,
       string_agg(strftime(t, '%Y-%m-%d %H:%M:%S') || '@' || CAST(close_pr AS VARCHAR), ',' ORDER BY t) AS points
FROM flags WHERE reversal_a AND t >= TIMESTAMP '{AS_OF}' - INTERVAL 8 DAY AND t <= TIMESTAMP '{AS_OF}'
GROUP BY symbol
""")
def recent_alerts(t: Tables) -> DataFrame:
    """TS-08: reversal-A alerts in the last 8 days."""
    r = TS.recent_alerts(TS.signals(bars(t)), "reversal_a", AS_OF, 8)
    pts = F.array_join(F.transform("points", lambda p: F.concat(F.date_format(p["t"], "yyyy-MM-dd HH:mm:ss"),
                                                                 F.lit("@"), p["close_pr"].cast("string"))), ",")
    return r.select("symbol", "alerts", pts.alias("points"))


@register("insert_ignore", f"""
WITH {_BARS_SQL},
existing AS (SELECT * FROM bars WHERE t < TIMESTAMP '{SPLIT_OLD_BEFORE}'),
new AS (SELECT symbol, t, open_pr, high_pr, low_pr, close_pr + 1000 AS close_pr, volume, 1 AS seq
        FROM bars WHERE t >= TIMESTAMP '{SPLIT_NEW_FROM}'
        UNION ALL
        SELECT symbol, t, open_pr, high_pr, low_pr, close_pr + 2000, volume, 2
        FROM bars WHERE t >= TIMESTAMP '{SPLIT_NEW_FROM}'),
firsts AS (SELECT * EXCLUDE (rn, seq) FROM
           (SELECT *, row_number() OVER (PARTITION BY symbol, t ORDER BY seq) AS rn FROM new) WHERE rn = 1),
app AS (SELECT * FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.symbol = f.symbol AND e.t = f.t)),
u AS (SELECT * FROM existing UNION ALL SELECT * FROM app)
SELECT symbol, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, open_pr, high_pr, low_pr, round(close_pr, 6) AS close_pr, volume
FROM u
""")
def insert_ignore(t: Tables) -> DataFrame:
    """TBL-03: the table after inserting an overlapping batch (two copies with
    different closes) with insert-or-ignore on (symbol, t)."""
    b = bars(t)
    existing = b.where(F.col("t") < F.lit(SPLIT_OLD_BEFORE).cast("timestamp_ntz"))
    newer = b.where(F.col("t") >= F.lit(SPLIT_NEW_FROM).cast("timestamp_ntz"))
    batch = (newer.withColumn("close_pr", F.col("close_pr") + 1000).withColumn("seq", F.lit(1))
             .unionByName(newer.withColumn("close_pr", F.col("close_pr") + 2000).withColumn("seq", F.lit(2))))
    app = sinks.insert_ignore(existing, batch, ["symbol", "t"], ["seq"]).drop("seq")
    u = existing.unionByName(app)
    return u.select("symbol", _tfmt(), "open_pr", "high_pr", "low_pr", r6("close_pr").alias("close_pr"), "volume")
