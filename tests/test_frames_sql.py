"""Frame helpers and SQL-registered functions."""

import datetime

from tessera.functions.sql import register_sql_functions
from tessera.operators import frames


def test_storage_round_trip(spark):
    df = spark.createDataFrame([(datetime.date(2018, 12, 10), 1.0, 2.0, 0.5, 1.5, 1.4, 10)],
                               "Date date, Open double, High double, Low double, Close double, `Adj Close` double, "
                               "Volume bigint")
    s = frames.to_storage(df)
    assert sorted(s.columns) == sorted(["t_date", "open_pr", "high_pr", "low_pr", "close_pr", "adj_close_pr", "volume"])
    assert s.first()["t_date"] == 20181210
    back = frames.from_storage(s).first()
    assert back["Date"] == datetime.date(2018, 12, 10) and back["Adj Close"] == 1.4


def test_conform_and_values(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "Day int, x string")
    c = frames.conform(df, ["x", "Visitors", "Day"], {"Visitors": "int"})
    assert c.columns == ["x", "Visitors", "Day"] and c.first()["Visitors"] is None
    assert frames.column_values(df, "x", 2, ["Day"]) == ["a", "b"]
    nulls, rest = frames.split_on_null(c, "Visitors")
    assert nulls.count() == 3 and rest.count() == 0


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT say_hello('world') a, list_contains(array('a', NULL), 'b') b, "
                  "list_contains(CAST(NULL AS ARRAY<STRING>), 'a') c, safe_div(7) d, safe_div(0) e, "
                  "clean_sentinel('\\\\N') f, name_id('quay 192.0.2.10') g").first()
    from tests.test_functions import uuid3_msb
    assert tuple(r) == ("hello , world", False, None, 14, 0, None, uuid3_msb("quay 192.0.2.10"))


def test_register_views(spark):
    from tessera.functions.sql import register_views
    register_views({"tv_nums": spark.range(5)})
    assert spark.sql("SELECT count(*) AS n FROM tv_nums").first()["n"] == 5
