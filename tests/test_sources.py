"""Readers, writers and table maintenance on small files."""

from pyspark.sql import functions as F

from tessera.sources import files, sinks

LOG = """51 pier u33db 198.51.100.4 7
51 pier u33dc 198.51.100.5 7
52 mill \\N 198.51.100.6 12
53 loft NULL 198.51.100.7 x"""

TYPED = ("t tinyint, s smallint, i int, l bigint, d double, w string, bad int, none string")


def test_read_wifi_log_space(spark, tmp_path):
    p = tmp_path / "log.txt"
    p.write_text(LOG + "\n\n")
    rows = files.read_wifi_log(spark, str(p), "\\s", with_row_id=True, has_bssid=False).collect()
    assert [(r["uid"], r["wifi_name"], r["geohash"], r["day_num"]) for r in rows] == [
        (51, "pier", "u33db", 7), (51, "pier", "u33dc", 7), (52, "mill", None, 12), (53, "loft", None, None)]
    assert len({r["vid"] for r in rows}) == 4


def test_read_wifi_log_tab_with_bssid(spark, tmp_path):
    p = tmp_path / "log.tsv"
    p.write_text("51\tpier \tu33db\t198.51.100.4\t7\t0a:1b\n52\tmill\tnull\tq\t9\t\\N\n")
    rows = files.read_wifi_log(spark, str(p), "\t").collect()
    assert [(r["wifi_name"], r["geohash"], r["bssid"]) for r in rows] == [("pier", "u33db", "0a:1b"), ("mill", None, None)]


def test_delimited_round_trip(spark, tmp_path):
    src = tmp_path / "in.txt"
    src.write_text("-7\t300\t70000\t5000000000\t-0.25\tbread & salt\t2.5\tNULL\n")
    df = files.read_delimited(spark, str(src), TYPED, "\t", "NULL")
    assert tuple(df.first()) == (-7, 300, 70000, 5000000000, -0.25, "bread & salt", None, None)
    out = tmp_path / "out"
    files.write_delimited(df, str(out), "\t", "NULL")
    text = "".join(p.read_text() for p in sorted(out.glob("part-*")))
    assert text.strip() == "-7\t300\t70000\t5000000000\t-0.25\tbread & salt\tNULL\tNULL"


def test_tag_distribution_reader_and_report(spark, tmp_path):
    from tessera.operators.profile import tag_distribution
    p = tmp_path / "tags.txt"
    p.write_text("1500=1.0:2\t2.0:3\n1600=1.0:5\n\\N=1.0:7\n3000001=0.5:1\n9=1.0:1\n")
    got = {(r["band"], r["k"]): r["sum_v"] for r in tag_distribution(files.read_tag_distribution(spark, str(p))).collect()}
    assert got == {("mp_media", 1.0): 7, ("mp_media", 2.0): 3, ("function", 0.5): 1}


def test_parse_follow_pairs(spark):
    lines = spark.createDataFrame([("((alice,1),(bob,2))",), ("((carol,3),(bob,2))",)], "value string")
    v, e = files.parse_follow_pairs(lines)
    assert sorted(tuple(r) for r in e.collect()) == [(1, 2), (3, 2)]
    assert {r["id"]: r["name"] for r in v.collect()} == {1: "alice", 2: "bob", 3: "carol"}


def test_app_meta_and_events(spark, tmp_path):
    meta = tmp_path / "meta.tsv"
    meta.write_text("x\ty\tapp1\tpkg1\tz\tgames\tw\tpuzzle\ta\tb\tfun,,casual\n")
    m = files.read_app_meta(spark, str(meta)).first()
    assert (m["app_name"], m["category"], m["sub_category"], m["tags"]) == ("app1", "games", "puzzle", "fun,,casual")
    ev = tmp_path / "open.json"
    ev.write_text('{"guid": "g1", "app_name": "app1", "open_time_and_ip": [{"open_time": "1544400000000", "ip": "x"}]}\n'
                  '{"guid": null, "app_name": "app1", "open_time_and_ip": []}\n')
    df = files.read_app_events(spark, [str(ev)], files.OPEN_EVENT_SCHEMA)
    assert df.count() == 1


def test_partitioned_paths(spark, tmp_path):
    for d in ("20181210", "20181209"):
        (tmp_path / d / "app1" / "open").mkdir(parents=True)
    paths = files.partitioned_paths(spark, str(tmp_path) + "/{date}/{key}/{type}", ["20181210", "20181208"],
                                    ["app1"], ["open", "install"])
    assert paths == [str(tmp_path) + "/20181210/app1/open"]


def test_bars_table_flow(spark):
    sinks.create_bars_table(spark, "bars_t")
    rows = [(20240101 + i, 1.0, 2.0, 0.5, 1.5, 1.5, 10, "AAA") for i in range(5)]
    df = spark.createDataFrame(rows, "t_date int, open_pr double, high_pr double, low_pr double, close_pr double, "
                                     "adj_close_pr double, volume bigint, symbol string")
    sinks.append_bars(df, "bars_t")
    newer = df.withColumn("t_date", F.col("t_date") + 3).withColumn("close_pr", F.lit(9.0))
    sinks.append_bars(sinks.insert_ignore(spark.table("bars_t"), newer, ["symbol", "t_date"]), "bars_t")
    got = sinks.read_bars(spark, "bars_t", 20240103, 20240107, ["AAA"]).orderBy("t_date").collect()
    assert [(r["t_date"], r["close_pr"]) for r in got] == [(20240103, 1.5), (20240104, 1.5), (20240105, 1.5),
                                                           (20240106, 9.0), (20240107, 9.0)]


def test_partition_overwrite_and_append(spark):
    spark.sql("DROP TABLE IF EXISTS wifi_out")
    spark.sql("CREATE TABLE wifi_out (uid bigint, wifi_id string, date_p string) USING parquet PARTITIONED BY (date_p)")
    a = spark.createDataFrame([(1, "x", "d1"), (2, "y", "d2")], "uid bigint, wifi_id string, date_p string")
    sinks.append_partition(a, "wifi_out")
    b = spark.createDataFrame([("z", "d1", 3)], "wifi_id string, date_p string, uid bigint")  # other column order
    sinks.overwrite_partitions(b, "wifi_out")
    got = sorted((r["uid"], r["wifi_id"], r["date_p"]) for r in spark.table("wifi_out").collect())
    assert got == [(2, "y", "d2"), (3, "z", "d1")]
    try:
        sinks.append_partition(b, "wifi_out", fail_if_partition_exists=True)
        raised = False
    except ValueError:
        raised = True
    assert raised


def test_cached_context(spark):
    df = spark.range(10)
    with sinks.cached(df) as c:
        assert c.is_cached
    assert not df.is_cached


def test_read_dated_prunes_partitions(spark, tmp_path):
    import contextlib
    import io
    base = str(tmp_path / "events")
    df = spark.createDataFrame([(i, f"2018121{i % 3}") for i in range(30)], "x int, date_p string")
    df.write.partitionBy("date_p").parquet(base)
    out = files.read_dated(spark, base, ["20181210", "20181212"])
    assert out.count() == 20
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "PartitionFilters: [cast(date_p" in buf.getvalue() and "IN (20181210,20181212)" in buf.getvalue()
