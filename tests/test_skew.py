"""Correctness when one key holds a third (or more) of all rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import merge_map
from tessera.operators import graph as G
from tessera.operators import stats as ST
from tessera.sources import sinks


def test_components_with_a_hub(spark):
    rnd = random.Random(1)
    n = 300
    hub = [(0, i) for i in range(1, 150)]                  # half of the edges touch vertex 0
    rest = [(rnd.randrange(150, n), rnd.randrange(150, n)) for _ in range(120)]
    e = spark.createDataFrame(hub + rest, "src bigint, dst bigint")
    v = spark.createDataFrame([(i,) for i in range(n)], "id bigint")
    got = {r["id"]: r["component"] for r in G.connected_components(v, e).collect()}
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in hub + rest:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    mins = {}
    for i in range(n):
        mins[find(i)] = min(mins.get(find(i), i), i)
    assert got == {i: mins[find(i)] for i in range(n)}


def test_merge_map_hot_group(spark):
    rows = [(1 if i % 3 else 2, f"k{i % 5}", i, i) for i in range(3000)]   # group 1 holds two thirds
    df = spark.createDataFrame(rows, "g int, k string, v int, o int").repartition(9)
    got = {r["g"]: r["merged"] for r in merge_map(df, ["g"], "k", "v", ["o"]).collect()}
    expect = {}
    for g, k, v, o in sorted(rows, key=lambda r: r[3]):
        expect.setdefault(g, {})[k] = v
    assert got == expect


def test_insert_ignore_hot_key(spark):
    batch = [("hot", 1, float(i), i) for i in range(2000)] + [("x", i, 0.0, 0) for i in range(10)]
    new = spark.createDataFrame(batch, "symbol string, t int, c double, seq int").repartition(7)
    existing = spark.createDataFrame([("x", 0, 9.0)], "symbol string, t int, c double")
    out = {(r["symbol"], r["t"]): r["c"] for r in sinks.insert_ignore(existing, new, ["symbol", "t"], ["seq"]).collect()}
    assert out[("hot", 1)] == 0.0 and ("x", 0) not in out and len(out) == 10


def test_quantiles_hot_value(spark):
    vals = [5.0] * 1000 + [float(i) for i in range(2000)]              # one value is a third of the rows
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(5)
    got = {r["q"]: r["value"] for r in ST.exact_quantiles(df, "v", [0.1, 0.25, 0.5, 0.9]).collect()}
    for q, v in got.items():
        assert abs(v - float(np.quantile(vals, q))) < 1e-9


def test_join_counted_spreads_a_hot_key(spark):
    """Two thirds of the rows on one key, automatic broadcast off: no task of the
    join gets more than about twice the mean."""
    from tessera.operators.skew import join_counted
    # small partitions stay as they are, so that sizes tell how rows were dealt
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        rows = spark.range(n).repartition(8).select(F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id")).alias("k"), "id")
        lookup = rows.groupBy("k").agg(F.min("id").alias("m"), F.count(F.lit(1)).alias("n"))
        out = join_counted(rows, lookup, "k", "n", n)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == n and max(sizes) < 2.5 * n / 8
        assert out.where("k = -1 and m <> 1").count() == 0 and out.where("k >= 0 and m <> k").count() == 0
        left = join_counted(rows.unionByName(spark.range(5).selectExpr("-7 AS k", "id")), lookup, "k", "n", n, "left")
        assert left.where("k = -7 and m is null").count() == 5 and left.count() == n + 5
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_wifi_nodes_with_a_hot_key(spark):
    """Half of the rows under one (wifi name, address): no task reads that share."""
    rows = [(i % 300, "hot" if i % 2 else f"w{i % 40}", "1.1.1.1" if i % 2 else f"ip{i % 70}", None, i) for i in range(6000)]
    rows += [(1, None, "ip1", None, 9000 + i) for i in range(50)]
    acts = spark.createDataFrame(rows, "uid int, wifi_name string, ip string, bssid string, vid bigint").repartition(11)
    acts = acts.withColumn("geohash", F.lit("g")).withColumn("day_num", F.lit(1))
    out = G.recognize_wifi(acts, "20240101", max_iter=6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    got = out.collect()
    assert len(got) == len(rows)
    by_ip = {}
    for r in got:
        if r["wifi_name"] is not None:
            by_ip.setdefault((r["wifi_name"], r["ip"]), set()).add(r["wifi_id"])
    assert all(len(ids) == 1 for ids in by_ip.values())
    alone = [r["wifi_id"] for r in got if r["wifi_name"] is None]
    assert sorted(map(int, alone)) == list(range(9000, 9050))


def test_insert_into_a_table_reads_touched_partitions_only(spark):
    name = "bars_touched"
    sinks.create_bars_table(spark, name)
    try:
        cols = spark.table(name).columns
        rest = [c for c in cols if c not in ("symbol", "t_date")]

        def rows(symbols, dates):
            df = spark.createDataFrame([(s, d) for s in symbols for d in dates], "symbol string, t_date int")
            return df.select(*[F.col(c) if c in ("symbol", "t_date") else F.lit(1).cast(spark.table(name).schema[c].dataType).alias(c) for c in cols])

        sinks.append_bars(rows([f"s{i}" for i in range(20)], range(20240101, 20240111)), name)
        batch = rows(["s3", "new"], range(20240108, 20240114))
        out = sinks.insert_ignore_into(spark, name, batch, ["symbol", "t_date"], rest)
        got = sorted((r["symbol"], r["t_date"]) for r in out.collect())
        assert got == [("new", d) for d in range(20240108, 20240114)] + [("s3", d) for d in (20240111, 20240112, 20240113)]
        plan = sinks._touched(spark, name, batch, ["symbol", "t_date"])._jdf.queryExecution().executedPlan().toString()
        assert "symbol" in plan.split("PartitionFilters")[1][:80]
        assert plan.count("Exchange") == plan.count("BroadcastExchange")
        read = sinks._touched(spark, name, batch, ["symbol", "t_date"]).select(F.input_file_name().alias("f")).distinct().collect()
        assert all("symbol=s3" in r["f"] for r in read)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
