"""Structured Streaming word count and MLlib helpers."""

import datetime
import random

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import ml as M
from tessera.operators import search as S
from tessera.streaming import wordcount as W


def test_stream_word_count_closed_windows(spark, tmp_path):
    base = datetime.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(base + datetime.timedelta(seconds=s), line) for s, line in
            [(0, "a b a"), (1, "b "), (4, "a"), (7, "c c"), (8, "")]]
    src = tmp_path / "in"
    spark.createDataFrame(rows, "ts timestamp, value string").coalesce(1).write.parquet(str(src))
    stream = spark.readStream.schema("ts timestamp, value string").parquet(str(src))
    counts = W.tumbling_word_count(W.words(stream, "value", "\\s"), "ts", "3 seconds", "0 seconds")
    out = W.run_available(counts, "append", "t", out_dir=str(tmp_path / "run"))
    got = {(r["window_start"].second, r["word"]): r["count"] for r in out.collect()}
    # windows [0,3) and [3,6) are closed by the watermark (max ts = 8 s); [6,9) stays open
    assert got == {(0, "a"): 2, (0, "b"): 2, (3, "a"): 1}
    # a replay returns every window
    again = W.replay(W.tumbling_word_count(W.words(stream, "value", "\\s"), "ts", "3 seconds", None),
                     ["window_start", "window_end", "word"], "t")
    got = {(r["window_start"].second, r["word"]): r["count"] for r in again.collect()}
    assert got == {(0, "a"): 2, (0, "b"): 2, (3, "a"): 1, (6, "c"): 2, (6, ""): 1}


def test_log_record_stream(spark, tmp_path):
    d = tmp_path / "lines"
    d.mkdir()
    (d / "f.txt").write_text("x\ny\n")
    recs = W.run_available(W.log_record_stream(spark, str(d), "topic1"), "append", "logs",
                           out_dir=str(tmp_path / "run2"))
    assert sorted((r["topic"], r["value"]) for r in recs.collect()) == [("topic1", "x"), ("topic1", "y")]


def test_positions_next_previous(spark):
    df = spark.createDataFrame([([2, 5, 9, 14],)], "p array<int>")
    starts = [0, 2, 6, 14, 30]
    row = df.select(*[S.next_position("p", F.lit(s)).alias(f"n{i}") for i, s in enumerate(starts)],
                    *[S.previous_position("p", F.lit(s)).alias(f"v{i}") for i, s in enumerate(starts)]).first()
    assert [row[f"n{i}"] for i in range(5)] == [2, 5, 9, None, None]
    assert [row[f"v{i}"] for i in range(5)] == [None, None, 5, 9, 14]


def test_listing_features_and_codes(spark):
    df = spark.createDataFrame([(1, ["p1", "p2"], ["Garden", "Cellar"], "two  rooms ", "2023-11-05 18:03:59",
                                 "high")],
                               "listing_id bigint, photos array<string>, features array<string>, "
                               "description string, created string, interest_level string")
    r = M.listing_features(df).withColumn("y", M.target_code(F.col("interest_level"))).first()
    assert (r["num_photos"], r["num_features"], r["num_description_words"]) == (2, 2, 4)
    assert (r["created_year"], r["created_month"], r["created_day"], r["created_hour"]) == (2023, 11, 5, 18)
    assert r["y"] == 0


def test_hash_split_and_folds_are_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = M.hash_split(df, "k", 67)
    assert a.count() + b.count() == 1000 and a.join(b, "k").count() == 0
    f1 = {r["k"]: r["fold"] for r in M.add_fold(df, "k", 5).collect()}
    f2 = {r["k"]: r["fold"] for r in M.add_fold(df.repartition(7), "k", 5).collect()}
    assert f1 == f2 and set(f1.values()) == {0, 1, 2, 3, 4}


def test_bag_of_words_pipeline(spark):
    from pyspark.ml import Pipeline
    docs = spark.createDataFrame([(1, "The cat and the dog, a cat!"), (2, "Dog days of summer; I x y")],
                                 "id bigint, text string")
    model = Pipeline(stages=M.bag_of_words("text", "bow", vocab=3)).fit(docs)
    vocab = model.stages[-1].vocabulary
    assert set(vocab) <= {"cat", "dog", "days", "summer"} and vocab[0] in ("cat", "dog") and len(vocab) == 3
    out = model.transform(docs).select("id", "bow").orderBy("id").collect()
    assert out[0]["bow"].size == 3 and out[0]["bow"].toArray().sum() >= 3


def test_boosting_goes_on_through_small_gains(spark):
    """Rounds that gain under 1 % do not stop the booster."""
    rng = random.Random(12)
    rows = []
    for i in range(600):
        x = [rng.random() for _ in range(4)]
        rows.append((Vectors.dense(x), float(rng.random() < 0.1 + 0.8 * (x[0] + x[1] > 1)), i % 3 == 0))
    df = spark.createDataFrame(rows, ["features", "label", "held_out"]).cache()
    whole = M.boosted("label", "held_out", depth=2).fit(df)
    early = M.boosted("label", "held_out", depth=2, tolerance=0.01).fit(df)
    held = df.where("held_out")
    loss = whole.evaluateEachIteration(held)
    assert whole.getNumTrees > early.getNumTrees
    assert whole.evaluateEachIteration(held)[-1] < early.evaluateEachIteration(held)[-1]
    assert all(b <= a for a, b in zip(loss, loss[1:]))  # no round before the end made it worse
