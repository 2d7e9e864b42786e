"""Golden values for the column helpers (FIXTURES.md section 2)."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import (clean_sentinel, day_sequence_desc, geohash, jvm_split, list_contains, merge_map,
                               merge_maps_last_wins, name_id, safe_div, say_hello)


def one(spark, expr, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("r")).first()["r"]


def test_say_hello(spark):
    df = spark.createDataFrame([("world",), (None,)], "n string")
    assert [r[0] for r in df.select(say_hello("n")).collect()] == ["hello , world", None]


@pytest.mark.parametrize("lst,s,expected", [
    (["a", "b", "c"], "a", True),
    (["a", "b", "c"], "d", False),
    (None, None, None),
    (["a", None, "c"], "d", False),
])
def test_list_contains(spark, lst, s, expected):
    df = spark.createDataFrame([(lst, s)], "l array<string>, s string")
    assert df.select(list_contains("l", "s")).first()[0] == expected


@pytest.mark.parametrize("lat,lon,n,expected", [
    (22.541113, 113.953404, 12, "ws101p6rdb08"),
    (57.64911, 10.40744, 11, "u4pruydqqvj"),
    (90.0, 180.0, 5, "zzzzz"),
    (0.0, 0.0, 5, "s0000"),
    (-1e-17, -1e-17, 5, "7zzzz"),
    (-90.0, -180.0, 5, "00000"),
    (22.541113, 113.953404, 0, "w"),
    (22.541113, 113.953404, 20, "ws101p6rdb08"),
])
def test_geohash(spark, lat, lon, n, expected):
    df = spark.createDataFrame([(lat, lon, n)], "lat double, lon double, n int")
    assert df.select(geohash("lat", "lon", F.col("n"))).first()[0] == expected


def test_geohash_prefix_property(spark):
    df = spark.range(200).select((F.col("id") * 0.7919 % 180 - 90).alias("lat"),
                                 (F.col("id") * 1.3 % 360 - 180).alias("lon"))
    rows = df.select(*[geohash("lat", "lon", n).alias(f"g{n}") for n in range(1, 13)]).collect()
    for r in rows:
        for n in range(1, 12):
            assert r[f"g{n + 1}"].startswith(r[f"g{n}"])


def test_geohash_null_and_out_of_range(spark):
    df = spark.createDataFrame([(None, 1.0)], "lat double, lon double")
    assert df.select(geohash("lat", "lon", 5)).first()[0] is None
    bad = spark.createDataFrame([(91.0, 0.0)], "lat double, lon double")
    with pytest.raises(Exception):
        bad.select(geohash("lat", "lon", 5)).collect()
    assert bad.select(geohash("lat", "lon", 5, on_out_of_range="null")).first()[0] is None


def test_safe_div(spark):
    df = spark.createDataFrame([(0,), (7,), (-7,)], "x int")
    assert [r[0] for r in df.select(safe_div("x")).collect()] == [0, 14, -14]


def uuid3_msb(s: str) -> int:
    """Definition: MD5 of the bytes, version 3 and IETF variant bits set,
    most significant 64 bits as a signed long."""
    import hashlib
    d = bytearray(hashlib.md5(s.encode()).digest())
    d[6] = (d[6] & 0x0F) | 0x30
    d[8] = (d[8] & 0x3F) | 0x80
    return int.from_bytes(bytes(d[:8]), "big", signed=True)


def test_name_id(spark):
    names = ["quay 192.0.2.10", "x", "", "ünïcode-名前"]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    assert [r[0] for r in df.select(name_id("s")).collect()] == [uuid3_msb(n) for n in names]


@pytest.mark.parametrize("line,expected", [("a b  ", ["a", "b"]), ("", [""]), (" ", []), ("a  b", ["a", "", "b"])])
def test_jvm_split(spark, line, expected):
    df = spark.createDataFrame([(line,)], "s string")
    assert df.select(jvm_split("s", " ")).first()[0] == expected


def test_day_sequence(spark):
    df = spark.createDataFrame([("20181210",)], "d string")
    days = df.select(day_sequence_desc("d", F.lit(30))).first()[0]
    assert len(days) == 31 and days[0] == "20181210" and days[-1] == "20181110"


def test_clean_sentinel(spark):
    df = spark.createDataFrame([("NULL",), ("\\N",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(clean_sentinel("s")).collect()] == [None, None, "x", None]


def test_merge_map_last_wins(spark):
    rows = [(1, "A", 1, 1), (1, "B", 2, 2), (1, "C", 3, 3), (1, "B", 20, 4), (1, "C", 30, 5),
            (2, None, 1, 1), (2, "a", None, 2)]
    df = spark.createDataFrame(rows, "g int, k string, v int, o int")
    out = {r["g"]: r["merged"] for r in merge_map(df, ["g"], "k", "v", ["o"]).collect()}
    assert out[1] == {"A": 1, "B": 20, "C": 30}
    assert out[2] == {"a": None}


def test_merge_map_partition_independent(spark):
    rows = [(1, f"k{i % 7}", i, i) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, k string, v int, o int")
    a = merge_map(df.repartition(1), ["g"], "k", "v", ["o"]).first()["merged"]
    b = merge_map(df.repartition(13), ["g"], "k", "v", ["o"]).first()["merged"]
    assert a == b and len(a) == 7


def test_merge_maps_array(spark):
    df = spark.createDataFrame([([{"a": 1, "b": 2}, {"b": 3, "c": 4}],)], "ms array<map<string,int>>")
    assert df.select(merge_maps_last_wins(F.col("ms"))).first()[0] == {"a": 1, "b": 3, "c": 4}
