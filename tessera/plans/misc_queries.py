"""Statistics, scalar-function, geohash and log-record queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, scalar
from ..operators import stats as ST
from ..operators.bands import band_join
from ..sources import sinks
from ..sources.tables import Tables
from .common import r6, register

# ------------------------------------------------------------ statistics ---


@register("value_counts", """
SELECT l_quantity, count(*) AS count FROM lineitem GROUP BY l_quantity
""")
def value_counts(t: Tables) -> DataFrame:
    """AGG-19: line counts per quantity."""
    return ST.value_counts(t.lineitem, "l_quantity")


@register("two_key_counts", """
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY 1, 2
""")
def two_key_counts(t: Tables) -> DataFrame:
    """AGG-20."""
    return ST.value_counts(t.lineitem, ["l_returnflag", "l_linestatus"])


@register("min_max_count", """
SELECT min(o_totalprice) AS min, max(o_totalprice) AS max, count(*) AS rows, count(o_totalprice) AS non_null
FROM orders
""")
def min_max_count(t: Tables) -> DataFrame:
    """AGG-21."""
    return ST.min_max_count(t.orders, "o_totalprice")


_DESCRIBE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql() -> str:
    parts = []
    for c in _DESCRIBE_COLS:
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
            f"round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
            f"round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("describe", _describe_sql())
def describe(t: Tables) -> DataFrame:
    """AGG-23: describe of four line-item columns (exact quartiles)."""
    d = ST.describe(t.lineitem, _DESCRIBE_COLS)
    return d.select("column", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register("five_number", """
SELECT l_returnflag, round(min(l_extendedprice), 6) AS min, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3,
       round(max(l_extendedprice), 6) AS max
FROM lineitem GROUP BY l_returnflag
""")
def five_number(t: Tables) -> DataFrame:
    """AGG-25: box-plot numbers of the extended price per return flag."""
    f = ST.five_number(t.lineitem, "l_returnflag", "l_extendedprice")
    return f.select("l_returnflag", *[r6(c).alias(c) for c in ("min", "q1", "median", "q3", "max")])


@register("histogram", """
WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, count(*) AS n
      FROM lineitem, mm WHERE l_extendedprice IS NOT NULL GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * (hi - lo) / 50, 6) AS lo,
       round(lo + (g.bin + 1) * (hi - lo) / 50, 6) AS hi, coalesce(b.n, 0) AS count
FROM (SELECT unnest(range(50)) AS bin) g CROSS JOIN mm LEFT JOIN b ON b.bin = g.bin
""")
def histogram(t: Tables) -> DataFrame:
    """AGG-24: 50-bin histogram of the extended price."""
    h = ST.histogram(t.lineitem, "l_extendedprice", 50)
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "count")


@register("p99_clip", """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.99) AS p99 FROM orders)
SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice,
       round(CASE WHEN o_totalprice IS NULL THEN NULL ELSE least(o_totalprice, p99) END, 6) AS clipped
FROM orders, q
""")
def p99_clip(t: Tables) -> DataFrame:
    """MTH-03: order prices clipped at their 99th percentile."""
    c = ST.clip_at_quantile(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 0.99, out="clipped")
    return c.select("o_orderkey", r6("o_totalprice").alias("o_totalprice"), r6("clipped").alias("clipped"))


@register("dropna", """
SELECT o_orderkey, l_linenumber, l_quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_quantity IS NOT NULL AND NOT isnan(l_quantity)
""")
def dropna(t: Tables) -> DataFrame:
    """FLT-08: orders left-joined with their lines, rows with a NULL dropped."""
    j = t.orders.select("o_orderkey").join(
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity"), "o_orderkey", "left")
    return ST.dropna(j)


@register("isin", """
SELECT p_partkey, p_type FROM part WHERE p_type IN ('ECONOMY', 'PROMO')
""")
def isin(t: Tables) -> DataFrame:
    """FLT-07."""
    return ST.isin(t.part.select("p_partkey", "p_type"), "p_type", ["ECONOMY", "PROMO"])


@register("sorted_prices", """
SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS row_no, o_orderkey, o_totalprice FROM orders
""")
def sorted_prices(t: Tables) -> DataFrame:
    """SRT-02: global sort of all order prices with positions (range
    partitioned, no single-partition window)."""
    return ST.sort_with_rank(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


@register("head_orders", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
ORDER BY orders.o_orderdate, o_orderkey LIMIT 10
""")
def head_orders(t: Tables) -> DataFrame:
    """SRT-03: the 10 earliest orders (a top-k, the limit is the feature)."""
    h = ST.head(t.orders, ["o_orderdate", "o_orderkey"], 10)
    return h.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


# --------------------------------------------------------------- scalars ---


@register("say_hello", """
SELECT c_custkey, 'hello , ' || c_name AS greeting FROM customer
""")
def say_hello(t: Tables) -> DataFrame:
    """STR-01."""
    return t.customer.select("c_custkey", scalar.say_hello("c_name").alias("greeting"))


@register("list_contains", """
SELECT p_partkey,
       CASE WHEN p_name IS NULL OR (CASE WHEN p_size > 45 THEN NULL ELSE 'widget' END) IS NULL THEN NULL
            ELSE list_contains(string_split(p_name, ' '), 'widget') END AS has_widget
FROM part
""")
def list_contains(t: Tables) -> DataFrame:
    """ARR-01: TRUE/FALSE, NULL when the probe is NULL (probe NULL for p_size > 45)."""
    probe = F.when(F.col("p_size") > 45, F.lit(None).cast("string")).otherwise(F.lit("widget"))
    return t.part.select("p_partkey", scalar.list_contains(F.split("p_name", " ", -1), probe).alias("has_widget"))


@register("safe_div", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber - 4 = 0 THEN 0 ELSE CAST(trunc(100.0 / (l_linenumber - 4)) AS BIGINT) END AS r
FROM lineitem
""")
def safe_div(t: Tables) -> DataFrame:
    """MTH-01: 100 div (line number - 4), 0 where the divisor is 0."""
    return t.lineitem.select("l_orderkey", "l_linenumber", scalar.safe_div(F.col("l_linenumber") - 4).alias("r"))


_NAME_ID_SQL = """CAST(CASE WHEN u >= 9223372036854775808 THEN u - 18446744073709551616 ELSE u END AS BIGINT)"""


@register("name_id", f"""
SELECT c_custkey, {_NAME_ID_SQL} AS id
FROM (SELECT c_custkey, CAST(CAST(('0x' || substr(h, 1, 12) || '3' || substr(h, 14, 3)) AS UBIGINT) AS HUGEINT) AS u
      FROM (SELECT c_custkey, md5(c_name) AS h FROM customer))
""")
def name_id(t: Tables) -> DataFrame:
    """MTH-04: name-based 64-bit ids of customer names."""
    return t.customer.select("c_custkey", scalar.name_id("c_name").alias("id"))


@register("epoch_day", """
SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events
""")
def epoch_day(t: Tables) -> DataFrame:
    """DAT-01: epoch milliseconds (as text) -> yyyyMMdd in UTC."""
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return t.events.select("event_id", scalar.epoch_ms_to_day(ms).alias("day"))


@register("date_sequence", """
SELECT o_orderkey, strftime(d, '%Y%m%d') AS day
FROM (SELECT o_orderkey, unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) - INTERVAL 3 DAY,
                                                -INTERVAL 1 DAY)) AS d FROM orders)
""")
def date_sequence(t: Tables) -> DataFrame:
    """GEN-09: each order date and the 3 days before it (N+1 days)."""
    return t.orders.select("o_orderkey", F.explode(scalar.day_sequence_desc(F.col("o_orderdate").cast("date"), F.lit(3)))
                           .alias("day"))


@register("jvm_split_words", """
WITH l AS (SELECT c_custkey, replace(c_name, '#', ' ') || CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE '' END AS line
           FROM customer)
SELECT c_custkey, CAST(len(CASE WHEN line = '' THEN ['']
                               WHEN regexp_replace(line, '(?: )+\\z', '') = '' THEN []::VARCHAR[]
                               ELSE string_split(regexp_replace(line, '(?: )+\\z', ''), ' ') END) AS INTEGER) AS n_words,
       CAST(len(string_split(line, ' ')) AS INTEGER) AS n_pieces
FROM l
""")
def jvm_split_words(t: Tables) -> DataFrame:
    """GEN-04 vs ARR-03: JVM split (trailing empties dropped) and plain split
    (kept) of customer names with '#' as a space and trailing blanks on
    every third customer."""
    line = F.concat(F.replace("c_name", F.lit("#"), F.lit(" ")),
                    F.when(F.col("c_custkey") % 3 == 0, F.lit("  ")).otherwise(F.lit("")))
    return t.customer.select("c_custkey", F.size(scalar.jvm_split(line, " ")).alias("n_words"),
                             scalar.word_count(line, " ").alias("n_pieces"))


# --------------------------------------------------------------- geohash ---

def points(t: Tables) -> DataFrame:
    c = t.customer
    lat = (F.col("c_custkey") * 7919 % 18001).cast("double") / F.lit(100.0) - F.lit(90.0)
    lon = (F.col("c_custkey") * 104729 % 36001).cast("double") / F.lit(100.0) - F.lit(180.0)
    return c.select("c_custkey", lat.alias("lat"), lon.alias("lon"))


# Plain bisection: 60 halvings, longitude first; a value at the middle goes up.
BISECTION_SQL = """
pts AS (SELECT c_custkey, CAST((c_custkey * 7919) % 18001 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(90 AS DOUBLE) AS lat,
               CAST((c_custkey * 104729) % 36001 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(180 AS DOUBLE) AS lon
        FROM customer),
b AS (SELECT c_custkey, lat, lon, 0 AS i, CAST(-180 AS DOUBLE) AS x0, CAST(180 AS DOUBLE) AS x1, CAST(-90 AS DOUBLE) AS y0,
             CAST(90 AS DOUBLE) AS y1, CAST(0 AS BIGINT) AS code FROM pts
      UNION ALL
      SELECT c_custkey, lat, lon, i + 1,
             CASE WHEN i % 2 = 0 AND lon >= (x0 + x1) / 2 THEN (x0 + x1) / 2 ELSE x0 END,
             CASE WHEN i % 2 = 0 AND lon < (x0 + x1) / 2 THEN (x0 + x1) / 2 ELSE x1 END,
             CASE WHEN i % 2 = 1 AND lat >= (y0 + y1) / 2 THEN (y0 + y1) / 2 ELSE y0 END,
             CASE WHEN i % 2 = 1 AND lat < (y0 + y1) / 2 THEN (y0 + y1) / 2 ELSE y1 END,
             code * 2 + CASE WHEN i % 2 = 0 THEN CASE WHEN lon >= (x0 + x1) / 2 THEN 1 ELSE 0 END
                             ELSE CASE WHEN lat >= (y0 + y1) / 2 THEN 1 ELSE 0 END END
      FROM b WHERE i < 60),
g AS (SELECT c_custkey, array_to_string(list_transform(range(12), lambda c:
        substr('0123456789bcdefghjkmnpqrstuvwxyz', 1 + CAST((code >> (55 - 5 * c)) & 31 AS INTEGER), 1)), '') AS gh12
      FROM b WHERE i = 60)"""


@register("geohash_points", f"""
WITH RECURSIVE {BISECTION_SQL}
SELECT g.c_custkey, gh12, substr(gh12, 1, 5) AS gh5, round(y0, 6) AS min_lat, round(y1, 6) AS max_lat,
       round(x0, 6) AS min_lon, round(x1, 6) AS max_lon
FROM g JOIN b ON b.c_custkey = g.c_custkey AND b.i = 25
""")
def geohash_points(t: Tables) -> DataFrame:
    """GEO-01/02: 12- and 5-character geohashes and the 5-character cell
    bounds of a point per customer (points from fixed arithmetic on the key)."""
    p = points(t)
    b = geo.geohash_bounds("lat", "lon", 5)
    return p.select("c_custkey", geo.geohash("lat", "lon", 12).alias("gh12"), geo.geohash("lat", "lon", 5).alias("gh5"),
                    *[r6(b[k]).alias(k) for k in ("min_lat", "max_lat", "min_lon", "max_lon")])


@register("geohash_cells", f"""
WITH RECURSIVE {BISECTION_SQL}
SELECT substr(gh12, 1, 3) AS cell, count(*) AS n FROM g GROUP BY 1
""")
def geohash_cells(t: Tables) -> DataFrame:
    """GEO-04: points per 3-character geohash cell."""
    p = points(t)
    return p.groupBy(geo.geohash("lat", "lon", 3).alias("cell")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ log records ---


@register("kafka_records", """
SELECT 'events' AS topic, CAST(row_number() OVER (ORDER BY event_id) + 1 AS VARCHAR) AS key,
       CAST(event_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) || ',' || event_type || ',' || CAST(value AS VARCHAR)
       AS value
FROM events
""")
def kafka_records(t: Tables) -> DataFrame:
    """SNK-06: events as text lines in event_id order behind a header line;
    key = line number (first record "2"), value = the line."""
    ev = t.events
    lines = ev.select("event_id", F.concat(F.col("event_id").cast("string"), F.lit(","), F.col("user_id").cast("string"),
                                           F.lit(","), F.col("event_type"), F.lit(","),
                                           F.col("value").cast("string")).alias("value"))
    numbered = sinks.global_row_number(lines, ["event_id"], out="row_no")
    numbered = numbered.withColumn("line_no", F.col("row_no") + 1)  # line 1 is the header
    return sinks.to_log_records(numbered, "events")


@register("price_bands", """
WITH li AS (SELECT round(l_extendedprice / l_quantity, 2) AS unit, l_quantity FROM lineitem),
bands AS (SELECT p_partkey, p_retailprice AS lo, p_retailprice * (1 + (p_partkey % 7) / 1000.0) AS hi FROM part)
SELECT p_partkey, count(*) AS n, round(sum(l_quantity), 2) AS quantity
FROM li JOIN bands ON unit BETWEEN lo AND hi GROUP BY p_partkey
""")
def price_bands(t: Tables) -> DataFrame:
    """JOI-13: every line item in the price bands of all parts, which overlap."""
    li = t.lineitem.select(F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("unit"), "l_quantity")
    bands = t.part.select("p_partkey", F.col("p_retailprice").alias("lo"),
                          (F.col("p_retailprice") * (1 + (F.col("p_partkey") % 7) / F.lit(1000.0))).alias("hi"))
    met = band_join(li, bands, "unit", "lo", "hi", sums=["l_quantity"])
    return met.groupBy("p_partkey").agg(F.sum("n").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
