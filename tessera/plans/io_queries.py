"""Sources, sinks, table maintenance and small helpers, each over whole tables.

A query that needs a file or a table writes it from the given tables into the
shared checkpoint folder (or the warehouse, under a name of its own), reads it
back with the reader under test, fixes the result with a checkpoint and removes
what it wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from ..functions.maps import merge_maps_last_wins
from ..functions.sql import register_sql_functions, register_views
from ..operators import frames, ml
from ..operators import profile as P
from ..operators import search as S
from ..session import cut_lineage
from ..sources import files, sinks
from ..sources.tables import Tables
from ..streaming import wordcount as W
from .common import array_text, map_text, r6, register, scratch, scratch_table
from .misc_queries import BISECTION_SQL, points
from .profile_queries import TAG_SEP, meta

# ----------------------------------------------------------------- files ---


@register("delimited_round_trip", """
SELECT c_custkey, c_name, CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
       round(c_acctbal, 6) AS c_acctbal, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def delimited_round_trip(t: Tables) -> DataFrame:
    """SRC-07: typed delimited rows with a null marker, written and read."""
    rows = t.customer.select("c_custkey", "c_name", F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).alias("c_nationkey"),
                             "c_acctbal", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    with scratch(t.spark) as path:
        files.write_delimited(rows, path, "\t", "NULL")
        return cut_lineage(files.read_delimited(t.spark, path, rows.schema, "\t", "NULL")
                           .withColumn("c_acctbal", r6("c_acctbal")))


@register("csv_header_round_trip", """
SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 6) AS s_acctbal FROM supplier
""")
def csv_header_round_trip(t: Tables) -> DataFrame:
    """SRC-08: CSV with a header line."""
    with scratch(t.spark) as path:
        t.supplier.write.option("header", "true").csv(path)
        return cut_lineage(files.read_csv(t.spark, path, t.supplier.schema).withColumn("s_acctbal", r6("s_acctbal")))


@register("text_lines_numbered", """
SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS line_no, o_orderkey || ' ' || o_orderpriority AS value
FROM orders
""")
def text_lines_numbered(t: Tables) -> DataFrame:
    """SNK-03 + WIN-08: rows written as text lines and numbered in file order."""
    lines = t.orders.select("o_orderkey", F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("value"))
    with scratch(t.spark) as path:
        # ordered files: the range partitions are written in order
        sinks.write_text(lines.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").select("value"), path)
        return cut_lineage(sinks.number_text_lines(t.spark.read.text(path)).select("line_no", "value"))


@register("app_meta_file", """
SELECT CAST(p_partkey AS VARCHAR) AS app_name, p_brand AS app_pkg, p_type AS category, p_brand AS sub_category, p_name AS tags
FROM part
""")
def app_meta_file(t: Tables) -> DataFrame:
    """SRC-03: header-less metadata TSV, five of eleven columns kept."""
    blank = [F.lit("-").alias(f"b{i}") for i in range(11)]
    cols = dict(zip((2, 3, 5, 7, 10), ("p_partkey", "p_brand", "p_type", "p_brand", "p_name")))
    rows = t.part.select(*[F.col(cols[i]).cast("string").alias(f"b{i}") if i in cols else blank[i] for i in range(11)])
    with scratch(t.spark) as path:
        rows.write.option("sep", "\t").csv(path)
        return cut_lineage(files.read_app_meta(t.spark, path))


@register("tag_file_bands", """
WITH cells AS (
  SELECT l_partkey, string_agg(CAST(l_quantity AS VARCHAR) || ':' || CAST(n AS VARCHAR), chr(9) ORDER BY l_quantity) AS distr
  FROM (SELECT l_partkey, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY l_partkey),
b AS (SELECT CASE l_partkey % 6 WHEN 1 THEN 'producer' WHEN 2 THEN 'interest' WHEN 3 THEN 'mp_media' WHEN 4 THEN 'function' END AS band,
             distr FROM cells),
kv AS (SELECT band, unnest(string_split(distr, chr(9))) AS kv FROM b WHERE band IS NOT NULL)
SELECT band, CAST(split_part(kv, ':', 1) AS DOUBLE) AS k, CAST(sum(CAST(split_part(kv, ':', 2) AS BIGINT)) AS BIGINT) AS sum_v
FROM kv GROUP BY 1, 2
""")
def tag_file_bands(t: Tables) -> DataFrame:
    """SRC-09 + FLT-04/06: histogram cells of every part in a file of
    ``tagid=distr`` lines; tag ids fall into all four bands, outside them, and on
    the sentinel."""
    hist = t.lineitem.groupBy("l_partkey", "l_quantity").agg(F.count(F.lit(1)).alias("n"))
    cells = hist.groupBy("l_partkey").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_quantity", "n"))),
                                 lambda e: F.concat(e["l_quantity"].cast("string"), F.lit(":"), e["n"].cast("string"))), "\t").alias("distr"))
    key, low = F.col("l_partkey"), {name: lo for name, lo, _ in P.TAG_BANDS}
    tag = (F.when(key % 6 == 0, F.lit("\\N")).when(key % 6 == 1, (key % 1000 + low["producer"]).cast("string"))
           .when(key % 6 == 2, (key % 1000 + low["interest"]).cast("string")).when(key % 6 == 3, (key % 480 + low["mp_media"]).cast("string"))
           .when(key % 6 == 4, (key % 1500 + low["function"]).cast("string")).otherwise(F.lit("77")))
    with scratch(t.spark) as path:
        sinks.write_text(cells.select(F.concat(tag, F.lit("="), "distr").alias("line")), path)
        return cut_lineage(P.tag_distribution(files.read_tag_distribution(t.spark, path)))


@register("libsvm_round_trip", """
SELECT CAST(c_nationkey AS DOUBLE) AS label, count(*) AS n, round(sum(c_acctbal), 4) AS balance,
       CAST(sum(c_custkey) AS DOUBLE) AS keys
FROM customer GROUP BY 1
""")
def libsvm_round_trip(t: Tables) -> DataFrame:
    """SRC-11: a sparse LibSVM file of every customer, summed by label."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = t.customer.select(F.col("c_nationkey").cast("double").alias("label"), F.col("c_custkey").cast("double").alias("key"), "c_acctbal")
    vectors = VectorAssembler(inputCols=["key", "c_acctbal"], outputCol="features").transform(rows).select("label", "features")
    with scratch(t.spark) as path:
        vectors.write.format("libsvm").save(path)
        v = vector_to_array("features")
        back = files.read_libsvm(t.spark, path, 2).select("label", v[0].alias("key"), v[1].alias("balance"))
        return cut_lineage(back.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("balance"), 4).alias("balance"),
                                                     F.sum("key").alias("keys")))


@register("listings_json", """
SELECT doc_id, CAST(len(string_split(lang || ',x', ',')) AS INTEGER) AS num_photos, CAST(1 + doc_id % 3 AS INTEGER) AS num_features,
       CAST(len(string_split(text, ' ')) AS INTEGER) AS num_description_words, 2024 AS created_year,
       CAST(1 + doc_id % 12 AS INTEGER) AS created_month, CAST(1 + doc_id % 28 AS INTEGER) AS created_day,
       CAST(doc_id % 24 AS INTEGER) AS created_hour, CAST(doc_id % 3 AS INTEGER) AS target,
       CASE doc_id % 3 WHEN 0 THEN 'new_a' WHEN 1 THEN 'new_a new_b' ELSE 'new_a new_b new_c' END AS phrases
FROM documents
""")
def listings_json(t: Tables) -> DataFrame:
    """SRC-10, ML-01/05, DAT-05, STR-08, MAP-03: every document as a listing in a
    JSON file, read back and turned into features and a target code."""
    i = F.col("doc_id")
    rows = t.documents.select(
        "doc_id", F.array("lang", F.lit("x")).alias("photos"),
        F.slice(F.array(F.lit("new a"), F.lit("new b"), F.lit("new c")), F.lit(1), (i % 3 + 1).cast("int")).alias("features"),
        F.col("text").alias("description"),
        F.format_string("2024-%02d-%02d %02d:00:00", (i % 12 + 1).cast("int"), (i % 28 + 1).cast("int"), (i % 24).cast("int")).alias("created"),
        F.element_at(F.array(F.lit("high"), F.lit("medium"), F.lit("low")), (i % 3 + 1).cast("int")).alias("interest_level"))
    with scratch(t.spark) as path:
        rows.write.json(path)
        back = ml.listing_features(files.read_listings(t.spark, path, rows.schema))
        return cut_lineage(back.select(
            "doc_id", "num_photos", "num_features", "num_description_words", "created_year", "created_month", "created_day",
            "created_hour", ml.target_code(F.col("interest_level")).alias("target"), scalar.phrase_tokens("features").alias("phrases")))


@register("follow_pairs", """
WITH e AS (SELECT a.c_custkey AS src, b.c_custkey AS dst FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1)
SELECT 'edge' AS kind, src AS a, dst AS b, NULL AS name FROM e
UNION ALL SELECT 'vertex', c_custkey, NULL, c_name FROM customer
WHERE c_custkey IN (SELECT src FROM e UNION SELECT dst FROM e)
""")
def follow_pairs(t: Tables) -> DataFrame:
    """SRC-13 + SET-02: ``((name,id),(name,id))`` lines of neighbouring customers."""
    c = t.customer
    nxt = c.select((F.col("c_custkey") - 1).alias("k"), F.col("c_custkey").alias("k2"), F.col("c_name").alias("n2"))
    lines = c.join(nxt, c["c_custkey"] == nxt["k"]).select(
        F.concat(F.lit("(("), "c_name", F.lit(","), F.col("c_custkey").cast("string"), F.lit("),("), "n2", F.lit(","),
                 F.col("k2").cast("string"), F.lit("))")).alias("value"))
    with scratch(t.spark) as path:
        sinks.write_text(lines, path)
        v, e = files.parse_follow_pairs(t.spark.read.text(path))
        none = F.lit(None)
        return cut_lineage(e.select(F.lit("edge").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), none.cast("string").alias("name"))
                           .unionByName(v.select(F.lit("vertex").alias("kind"), F.col("id").alias("a"), none.cast("bigint").alias("b"), "name")))


@register("dated_paths", """
SELECT l_returnflag AS app, strftime(l_shipdate, '%Y%m') AS month, count(*) AS n
FROM lineitem GROUP BY 1, 2
""")
def dated_paths(t: Tables) -> DataFrame:
    """SRC-04/05: one JSON folder per month and key; the year before and the year
    after the data are asked for, too, and one template ends in a wildcard."""
    li = t.lineitem.select(F.date_format("l_shipdate", "yyyyMM").alias("month"), F.col("l_returnflag").alias("app"))
    found = [r[0] for r in li.select("month").distinct().orderBy("month").collect()]  # calendar months: a bounded list
    with scratch(t.spark) as path:
        li.select("month", "app", F.col("app").alias("guid")).write.partitionBy("month", "app").json(path)
        years = (int(found[0][:4]) - 1, int(found[-1][:4]) + 1) if found else ()
        found = [f"{y}{m:02d}" for y in years[:1] for m in range(1, 13)] + found + [f"{y}{m:02d}" for y in years[1:] for m in range(1, 13)]
        templates = [f"{path}/month={{date}}/app={{key}}", f"{path}/month={{date}}/app={{key}}*"]
        keys = [r[0] for r in li.select("app").distinct().collect()]  # the return flags
        paths = [files.partitioned_paths(t.spark, x, found, keys, [""]) for x in templates]
        assert len(paths[0]) == len(paths[1])
        rows = files.read_app_events(t.spark, paths[1], "guid string").withColumn("file", F.col("_metadata.file_path"))
        return cut_lineage(rows.groupBy(F.col("guid").alias("app"), F.regexp_extract("file", "month=([0-9]+)", 1).alias("month"))
                           .agg(F.count(F.lit(1)).alias("n")))


@register("dated_partitions", """
SELECT strftime(o_orderdate, '%Y%m') AS date_p, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders WHERE month(o_orderdate) IN (3, 11) GROUP BY 1
""")
def dated_partitions(t: Tables) -> DataFrame:
    """SRC-05/06: a dated dataset read for some of its dates only."""
    o = t.orders.select(F.date_format("o_orderdate", "yyyyMM").alias("date_p"), "o_totalprice")
    dates = [r[0] for r in o.select("date_p").distinct().collect() if r[0][4:] in ("03", "11")]
    with scratch(t.spark) as path:
        o.write.partitionBy("date_p").parquet(path)
        rows = files.read_dated(t.spark, path, dates)
        return cut_lineage(rows.groupBy(F.col("date_p").cast("string").alias("date_p"))
                           .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")))


@register("wifi_log_file", """
SELECT user_id AS uid, event_type AS wifi_name, CASE WHEN event_id % 4 = 0 THEN NULL ELSE substr(md5(CAST(event_id AS VARCHAR)), 1, 6) END AS geohash,
       strftime(ts, '%d-%H') AS ip, CAST(day(ts) AS INTEGER) AS day_num, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'b' || (event_id % 9) END AS bssid
FROM events
""")
def wifi_log_file(t: Tables) -> DataFrame:
    """SRC-01/02, NUL-01, WIN-08: every event as a line of a connection log, with
    both null markers; the row ids are unique."""
    i = F.col("event_id")
    geo_text = F.when(i % 4 == 0, F.when(i % 8 == 0, F.lit("\\N")).otherwise(F.lit("Null"))).otherwise(F.substring(F.md5(i.cast("string")), 1, 6))
    bssid = F.when(i % 3 == 0, F.lit("NULL")).otherwise(F.concat(F.lit("b"), (i % 9).cast("string")))
    rows = t.events.select(F.concat_ws("\t", F.col("user_id").cast("string"), "event_type", geo_text, F.date_format("ts", "dd-HH"),
                                       F.dayofmonth("ts").cast("string"), bssid).alias("value"))
    with scratch(t.spark) as path:
        sinks.write_text(rows, path)
        log = cut_lineage(files.read_wifi_log(t.spark, path, "\t", with_row_id=True))
        assert log.select("vid").distinct().count() == log.count()
        return log.drop("vid")


# ---------------------------------------------------------- events in JSON ---

_EVENT_SQL = """
o AS (SELECT CAST(o_custkey AS VARCHAR) AS guid, CAST(l_partkey AS VARCHAR) AS app_name, strftime(o_orderdate, '%Y%m%d') AS day
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 11 <> 0),
i AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS guid, CAST(l_partkey AS VARCHAR) AS app_name
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 11 <> 0 AND o_custkey % 4 <> 0 AND l_returnflag <> 'N')"""


def _kv(key: str, val: str) -> str:
    return f"string_agg({key} || '=' || CAST({val} AS VARCHAR), ',' ORDER BY {key})"


@register("event_file_profile", f"""
WITH {_EVENT_SQL},
dim AS (SELECT CAST(p_partkey AS VARCHAR) AS app_name, p_type AS category, p_brand AS sub FROM part),
inst AS (SELECT guid, string_agg(app_name, ',' ORDER BY app_name) AS install_app FROM i GROUP BY guid),
icat AS (SELECT guid, {_kv('k', 'n')} AS m FROM (SELECT guid, category AS k, count(DISTINCT app_name) AS n FROM i JOIN dim USING (app_name)
         WHERE length(category) > 0 GROUP BY 1, 2) GROUP BY guid),
oapp AS (SELECT guid, {_kv('app_name', 'd')} AS md, {_kv('app_name', 'n')} AS mt FROM (
         SELECT guid, app_name, count(DISTINCT day) AS d, count(*) AS n FROM o GROUP BY 1, 2) GROUP BY guid),
osub AS (SELECT guid, {_kv('k', 'd')} AS md, {_kv('k', 'n')} AS mt FROM (
         SELECT guid, sub AS k, count(DISTINCT day) AS d, count(*) AS n FROM o JOIN dim USING (app_name) WHERE length(sub) > 0
         GROUP BY 1, 2) GROUP BY guid)
SELECT guid, install_app, icat.m AS install_category_count, oapp.md AS open_app_days, oapp.mt AS open_app_times,
       osub.md AS open_subcategory_days, osub.mt AS open_subcategory_times
FROM inst LEFT JOIN icat USING (guid) LEFT JOIN oapp USING (guid) LEFT JOIN osub USING (guid)
""")
def event_file_profile(t: Tables) -> DataFrame:
    """GEN-01/02, JSN-01, FLT-01, PRO-02/03/04: open and install events as nested
    JSON files (some without user), users with opens but no installs, and the
    profile built from them."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag")
    both = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    guid = F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey").cast("string"))
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")
    opened = both.groupBy("o_orderkey", guid.alias("guid"), F.col("l_partkey").cast("string").alias("app_name")).agg(
        F.collect_list(F.struct(ms.alias("open_time"), F.lit("0.0.0.0").alias("ip"))).alias("open_time_and_ip"))
    installed = (both.where((F.col("o_custkey") % 4 != 0) & (F.col("l_returnflag") != "N")).groupBy("o_orderkey", guid.alias("guid"))
                 .agg(F.collect_list(F.col("l_partkey").cast("string")).alias("installed_applist")))
    with scratch(t.spark) as path:
        opened.drop("o_orderkey").write.json(f"{path}/open")
        installed.drop("o_orderkey").write.json(f"{path}/install")
        opens_read = P.open_actions_from_events(files.read_app_events(t.spark, f"{path}/open", files.OPEN_EVENT_SCHEMA))
        installs_read = P.installs_from_events(files.read_app_events(t.spark, f"{path}/install", files.INSTALL_EVENT_SCHEMA))
        apps = meta(t).withColumn("app_name", F.col("app_name").cast("string"))
        df = P.app_profile(installs_read, opens_read, apps, "20240101", TAG_SEP)
        return cut_lineage(df.select("guid", array_text("install_app").alias("install_app"), *[map_text(c).alias(c) for c in (
            "install_category_count", "open_app_days", "open_app_times", "open_subcategory_days", "open_subcategory_times")]))


# ---------------------------------------------------------------- tables ---

@register("partition_overwrite", """
SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN 'second' ELSE 'first' END AS run FROM events
WHERE event_type <> 'click' OR event_id % 2 = 0
""")
def partition_overwrite(t: Tables) -> DataFrame:
    """SNK-01: overwriting replaces the partitions of the new rows only."""
    first = t.events.select("event_id", F.lit("first").alias("run"), "event_type")
    again = t.events.where("event_type = 'click' AND event_id % 2 = 0").select("event_type", F.lit("second").alias("run"), "event_id")
    with scratch_table(t.spark, "event_id bigint, run string, event_type string", "event_type") as name:
        sinks.append_partition(first, name)
        sinks.overwrite_partitions(again, name)  # columns in another order
        return cut_lineage(t.spark.table(name))


@register("partition_append", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1
""")
def partition_append(t: Tables) -> DataFrame:
    """SNK-02: appended in two parts; a partition that exists is refused on request."""
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    with scratch_table(t.spark, "o_orderkey bigint, o_totalprice double, o_orderstatus string", "o_orderstatus") as name:
        sinks.append_partition(rows.where("o_orderkey % 2 = 0"), name)
        sinks.append_partition(rows.where("o_orderkey % 2 = 1"), name)
        try:
            sinks.append_partition(rows, name, "o_orderstatus", fail_if_partition_exists=True)
            raise AssertionError("an existing partition was not refused")
        except ValueError:
            pass
        return cut_lineage(t.spark.table(name).groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")))


_DAILY_SQL = """
bars AS (SELECT event_type AS symbol, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS t_date, first(value ORDER BY ts, event_id) AS open_pr,
                max(value) AS high_pr, min(value) AS low_pr, last(value ORDER BY ts, event_id) AS close_pr, count(*) AS volume
         FROM events GROUP BY 1, 2)"""


def daily_bars(t: Tables) -> DataFrame:
    from ..operators import timeseries as TS

    b = TS.bars_from_ticks(t.events, "event_type", "ts", "value", "event_id", "day")
    return b.select(F.col("t").cast("date").alias("Date"), F.col("open_pr").alias("Open"), F.col("high_pr").alias("High"),
                    F.col("low_pr").alias("Low"), F.col("close_pr").alias("Close"), F.col("close_pr").alias("Adj Close"),
                    F.col("volume").alias("Volume"), "symbol")


@register("bars_table", f"""
WITH {_DAILY_SQL}
SELECT symbol, t_date, round(open_pr, 6) AS open_pr, round(high_pr, 6) AS high_pr, round(low_pr, 6) AS low_pr,
       round(close_pr, 6) AS close_pr, volume
FROM bars WHERE t_date BETWEEN 20240105 AND 20240120 AND symbol <> 'click'
""")
def bars_table(t: Tables) -> DataFrame:
    """TBL-01/02/04/05, PRJ-03, DAT-02: provider bars in storage form, appended to
    a table, appended again without the rows that exist, and read for a range
    of dates and some symbols."""
    rows = frames.to_storage(daily_bars(t))
    symbols = [r[0] for r in t.events.select("event_type").distinct().collect() if r[0] != "click"]  # event types: a short list
    with scratch_table(t.spark, sinks.BARS_DDL, "symbol", create=sinks.create_bars_table) as name:
        sinks.append_bars(rows.where("t_date <= 20240112"), name)
        sinks.append_bars(cut_lineage(sinks.insert_ignore_into(t.spark, name, rows, ["symbol", "t_date"])), name)
        out = sinks.read_bars(t.spark, name, 20240105, 20240120, symbols)
        return cut_lineage(out.select("symbol", "t_date", *[r6(c).alias(c) for c in ("open_pr", "high_pr", "low_pr", "close_pr")], "volume"))


@register("provider_frames", f"""
WITH {_DAILY_SQL}
SELECT symbol, strftime(strptime(CAST(t_date AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS "Date", round(close_pr, 6) AS "Close",
       CAST(NULL AS DOUBLE) AS "Split", volume AS "Volume"
FROM bars
""")
def provider_frames(t: Tables) -> DataFrame:
    """PRJ-03/04, DAT-02: to storage form and back, then a fixed column list with
    a column that is not there."""
    back = frames.from_storage(frames.to_storage(daily_bars(t)))
    out = frames.conform(back, ["symbol", "Date", "Close", "Split", "Volume"], {"Split": "double"})
    return out.withColumn("Date", F.date_format("Date", "yyyy-MM-dd")).withColumn("Close", r6("Close"))


@register("persisted_twice", """
SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1
""")
def persisted_twice(t: Tables) -> DataFrame:
    """TBL-06: an input that two aggregates read is kept while both run."""
    with sinks.cached(t.orders.select("o_custkey", "o_totalprice")) as o:
        n = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
        top = o.groupBy("o_custkey").agg(F.max("o_totalprice").alias("top"))
        return cut_lineage(n.join(top, "o_custkey"))


# --------------------------------------------------------------- helpers ---

@register("split_null_branches", """
SELECT CASE WHEN p IS NULL THEN 'absent' ELSE 'present' END AS branch, count(*) AS n
FROM (SELECT CASE WHEN l_discount < 0.03 THEN NULL ELSE l_discount END AS p FROM lineitem) GROUP BY 1
""")
def split_null_branches(t: Tables) -> DataFrame:
    """FLT-02: rows without and with a value as two frames."""
    rows = t.lineitem.select(F.when(F.col("l_discount") >= 0.03, F.col("l_discount")).alias("p"))
    absent, present = frames.split_on_null(rows, "p")
    both = absent.select(F.lit("absent").alias("branch")).unionByName(present.select(F.lit("present").alias("branch")))
    return both.groupBy("branch").agg(F.count(F.lit(1)).alias("n"))


@register("text_helpers", """
SELECT c_custkey, CAST(c_custkey AS VARCHAR) || '->' || c_mktsegment AS edge,
       CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN NULL ELSE c_name END AS cleaned,
       replace(c_name, ' ', '_') || ' ' || replace(c_mktsegment, ' ', '_') AS phrases,
       CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 END AS code
FROM customer
""")
def text_helpers(t: Tables) -> DataFrame:
    """STR-06, NUL-01, STR-08, MAP-03 on every customer."""
    k = F.col("c_custkey")
    marked = F.when(k % 3 == 0, F.lit("NULL")).when(k % 3 == 1, F.lit("\\N")).otherwise(F.col("c_name"))
    return t.customer.select("c_custkey", scalar.edge_label("c_custkey", "c_mktsegment").alias("edge"), scalar.clean_sentinel(marked).alias("cleaned"),
                             scalar.phrase_tokens(F.array("c_name", "c_mktsegment")).alias("phrases"),
                             scalar.code_map("c_mktsegment", {"BUILDING": 0, "MACHINERY": 1}).alias("code"))


@register("date_helpers", """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS as_int, strftime(o_orderdate, '%Y-%m-%d') AS and_back,
       strftime(CAST(o_orderdate AS DATE) - INTERVAL 3 MONTH, '%Y-%m-%d') AS quarter_before
FROM orders
""")
def date_helpers(t: Tables) -> DataFrame:
    """DAT-02/04: day numbers and back, and the day three months before."""
    d = F.col("o_orderdate").cast("date")
    n = scalar.date_to_int(d)
    return t.orders.select("o_orderkey", n.alias("as_int"), F.date_format(scalar.int_to_date(n), "yyyy-MM-dd").alias("and_back"),
                           F.date_format(frames.months_before(d, 3), "yyyy-MM-dd").alias("quarter_before"))


@register("map_merge", """
WITH m AS (SELECT l_orderkey, l_linenumber, l_returnflag AS k, l_quantity AS v FROM lineitem)
SELECT l_orderkey, string_agg(k || '=' || CAST(v AS VARCHAR), ',' ORDER BY k) AS merged
FROM (SELECT l_orderkey, k, last(v ORDER BY l_linenumber, v) AS v FROM m GROUP BY 1, 2) GROUP BY 1
""")
def map_merge(t: Tables) -> DataFrame:
    """MAP-01/02, UDF-01: the one-entry maps of an order's lines, later lines
    winning (an order has seven lines at most)."""
    lists = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag", "l_quantity"))).alias("s"))
    maps = F.transform("s", lambda e: F.create_map(e["l_returnflag"], e["l_quantity"]))
    return lists.select("l_orderkey", map_text(merge_maps_last_wins(maps)).alias("merged"))


@register("position_steps", """
WITH p AS (SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber) AS ns FROM lineitem GROUP BY 1)
SELECT l_orderkey, CAST(list_min(list_filter(ns, lambda x: x > 2)) AS INTEGER) AS next, CAST(list_max(list_filter(ns, lambda x: x < 2)) AS INTEGER) AS previous
FROM p
""")
def position_steps(t: Tables) -> DataFrame:
    """WIN-09: next and previous position relative to a start, per order."""
    p = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("ns"))
    return p.select("l_orderkey", S.next_position("ns", F.lit(2)).alias("next"), S.previous_position("ns", F.lit(2)).alias("previous"))


@register("sql_functions", """
SELECT c_custkey, 'hello , ' || c_name AS greeting, CASE WHEN c_nationkey = 0 THEN 0 ELSE 100 // c_nationkey END AS part,
       list_contains(['BUILDING', 'MACHINERY'], c_mktsegment) AS listed,
       CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_name END AS cleaned
FROM customer
""")
def sql_functions(t: Tables) -> DataFrame:
    """UDF-02/03, TBL-07: the helpers as session SQL functions over a named view."""
    register_sql_functions(t.spark)
    view = f"customer_{uuid.uuid4().hex}"
    register_views({view: t.customer})
    return t.spark.sql(f"""
        SELECT c_custkey, say_hello(c_name) AS greeting, safe_div(CAST(c_nationkey AS BIGINT)) AS part,
               list_contains(array('BUILDING', 'MACHINERY'), c_mktsegment) AS listed,
               clean_sentinel(CASE WHEN c_custkey % 2 = 0 THEN 'NULL' ELSE c_name END) AS cleaned
        FROM {view}""")


@register("column_to_list", """
SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25
""")
def column_to_list(t: Tables) -> DataFrame:
    """PRJ-05, SNK-04, FLT-11: a bounded column as a list, and the rows of its keys."""
    top = sinks.preview(t.orders.select("o_orderkey", "o_totalprice"), 25, [F.desc("o_totalprice"), F.asc("o_orderkey")])
    keys = frames.column_values(top, "o_orderkey", 25)
    return t.orders.where(F.col("o_orderkey").isin(keys)).select("o_orderkey")


@register("geohash_order", """
WITH RECURSIVE """ + BISECTION_SQL + """
SELECT CAST(row_number() OVER (ORDER BY gh7, c_custkey) AS BIGINT) AS row_no, c_custkey, gh7
FROM (SELECT c_custkey, substr(gh12, 1, 7) AS gh7 FROM g)
""")
def geohash_order(t: Tables) -> DataFrame:
    """GEO-03: cells in geohash order, from the SQL function ``geohash``."""
    register_sql_functions(t.spark)
    view = f"points_{uuid.uuid4().hex}"
    register_views({view: points(t)})
    cells = t.spark.sql(f"SELECT c_custkey, geohash(lat, lon, 7) AS gh7 FROM {view}")
    return sinks.global_row_number(cells, ["gh7", "c_custkey"], out="row_no")


# ------------------------------------------------------- search and streams ---

_WORDS_SQL = """
l AS (SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM documents),
c AS (SELECT regexp_replace(line, '[ \\t\\x0b\\f]+\\z', '') AS line, line AS whole FROM l),
w AS (SELECT unnest(CASE WHEN whole = '' THEN [''] WHEN line = '' THEN []::VARCHAR[] ELSE string_split_regex(line, '[ \\t\\x0b\\f]') END) AS word FROM c)"""


@register("streamed_words", """
WITH """ + _WORDS_SQL + """
SELECT word, count(*) AS count FROM w GROUP BY word
""")
def streamed_words(t: Tables) -> DataFrame:
    """GEN-05, STM-02/03, SRC-14: the lines of all documents as a text stream,
    cut into words and counted; without window bounds, over one window that
    holds the whole replay."""
    with scratch(t.spark) as path:
        sinks.write_text(S.text_lines(t.documents, "text").select("line"), path)
        lines = files.stream_lines(t.spark, "text", path, wholetext="false", lineSep="\n")
        stamped = W.with_processing_time(lines).withColumn("ts", F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 3_600_000) * 3_600_000))
        counts = W.tumbling_word_count(W.words(stamped, "value", "[ \\t\\x0b\\f]"), "ts", "3600000 seconds", None, keep_window=False)
        return W.replay(counts, ["word"], "words", state_partitions=t.spark.sparkContext.defaultParallelism)


@register("streamed_log_records", """
SELECT 'orders' AS topic, CAST(NULL AS VARCHAR) AS key, CAST(o_orderkey AS VARCHAR) || ' ' || o_orderstatus AS value FROM orders
""")
def streamed_log_records(t: Tables) -> DataFrame:
    """STM-04, SNK-05: a text stream as keyless records, written by a file sink."""
    with scratch(t.spark) as path:
        sinks.write_text(t.orders.select(F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("v")), f"{path}/in")
        q = sinks.stream_out(W.log_record_stream(t.spark, f"{path}/in", "orders"), "parquet", checkpoint=f"{path}/state",
                             trigger={"availableNow": True}, path=f"{path}/out")
        q.awaitTermination()
        return cut_lineage(t.spark.read.parquet(f"{path}/out"))
