"""Processing-time windows that close by a timer."""

import time
from collections import Counter

from tessera.streaming import wordcount as W


def lines(spark, folder):
    return spark.readStream.format("text").load(str(folder))


def test_the_last_window_closes_without_another_row(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("x y x\n\nz x\n")
    counts = W.closing_word_count(W.words(lines(spark, folder), "value", " ", keep=()), 1)
    q = counts.writeStream.format("memory").queryName("closing_test").outputMode("append").trigger(processingTime="200 milliseconds").start()
    try:
        until = time.time() + 90
        while time.time() < until and not W._closed(q):
            time.sleep(0.2)
        first = [tuple(r) for r in spark.sql("SELECT word, count FROM closing_test").collect()]
        assert Counter(dict(first)) == {"x": 3, "y": 1, "z": 1, "": 1} and len(first) == 4
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 0
        (folder / "b.txt").write_text("x x\n")
        until = time.time() + 90
        while time.time() < until and spark.sql("SELECT * FROM closing_test").count() < 5:
            time.sleep(0.2)
        while time.time() < until and not W._closed(q):
            time.sleep(0.2)
        rows = spark.sql("SELECT word, window_start, window_end, count FROM closing_test").collect()
        assert [r["count"] for r in rows if r["word"] == "x"] in ([3, 2], [2, 3]) and len(rows) == 5
        assert len({(r["word"], r["window_start"]) for r in rows}) == 5
        assert all((r["window_end"] - r["window_start"]).total_seconds() == 1 for r in rows)
    finally:
        q.stop()


def test_rows_of_several_windows_are_counted_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(6):
        (folder / f"{i}.txt").write_text("hot hot hot\ncold\n" * 50)
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(folder))
    out = W.run_until_closed(W.closing_word_count(W.words(stream, "value", " ", keep=()), 0.5), "t", every="100 milliseconds", state_partitions=2)
    rows = out.collect()
    assert {w: sum(r["count"] for r in rows if r["word"] == w) for w in ("hot", "cold")} == {"hot": 900, "cold": 300}
    assert len({(r["word"], r["window_start"]) for r in rows}) == len(rows)


def test_an_empty_stream_ends(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("")
    out = W.run_until_closed(W.closing_word_count(W.words(lines(spark, tmp_path / "in"), "value", " ", keep=()), 0.5), "e", every="100 milliseconds")
    assert out.count() == 0
