import random
import zlib

import numpy as np

from tessera.llm import quality as Q

from .helpers import frame, prose

SMALL = Q.Settings(buckets=1 << 14, epochs=4, max_rows=500)


def data(n=400):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        docs.append((i, prose(rng, rng.randrange(20, 80)) if good else " ".join(f"junk{rng.randrange(50)}!!" for _ in range(40))))
        labels.append((i, int(good)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = data()
    out = Q.classify(frame(spark, docs), spark.createDataFrame(labels, "doc_id bigint, quality int"), settings=SMALL).collect()
    y = dict(labels)
    assert len(out) == len(docs)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in out if r["held_out"]]
    assert np.mean([r["predicted"] == y[r["doc_id"]] for r in held]) > 0.95


def test_held_out_labels_change_nothing(spark):
    docs, labels = data(120)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (Q.fit(frame(spark, docs), spark.createDataFrame(x, "doc_id bigint, quality int"), settings=SMALL) for x in (labels, flipped))
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_real_documents(spark):
    from tessera.sources.tables import table

    sf = "/root/testdata/sf0.01"
    out = Q.classify(table(spark, sf, "documents"), table(spark, sf, "labels")).join(table(spark, sf, "labels"), "doc_id")
    held = out.where("held_out").select("quality", "predicted").collect()
    assert np.mean([r[0] == r[1] for r in held]) > 0.9
    good = [r[1] for r in held if r[0] == 1]
    assert np.mean(good) > 0.95


def test_features_of_a_text():
    f = Q.Features(SMALL)
    assert len(f.of(b"")) == 0 and len(f.of(b" \n\t")) == 0
    assert (f.of(b"Abc abc") == f.of(b"abc ABC")).all()
    # 2 words, 1 pair, and of " abc " three 3-grams and two 4-grams a word
    assert len(f.of(b"abc abc")) == 2 + 1 + 2 * 5
    a, b = f.of(b"x y"), f.of(b"q x y q")
    assert set(a.tolist()) <= set(b.tolist())


def test_edges(spark):
    schema = "doc_id bigint, text string, score string, held_out int, y int"
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert Q.classify(spark.createDataFrame([], schema), none, settings=SMALL).count() == 0
    rows = [(None, None, "s", 0, 0), (1, "", "s", 0, 0), (1, "", "s", 0, 0), (2, "word " * 20_000, "s", 0, 0)]
    out = Q.classify(spark.createDataFrame(rows, schema), none, settings=SMALL).collect()
    assert len(out) == 4 and {r["score"] for r in out} == {0.5}  # no label: the share of class 1 is unknown
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 7)], "doc_id bigint, quality int")
    assert {r["score"] for r in Q.classify(spark.createDataFrame(rows, schema), labels, settings=SMALL).collect()} == {0.5}


def test_long_labelled_texts_are_learned_from(spark):
    docs, labels = data(100)
    long = (1001, "rarely " * 30_000)
    assert zlib.crc32(b"1001") % 5
    a, b = (Q.fit(frame(spark, [*docs, long]), spark.createDataFrame([*labels, (1001, y)], "doc_id bigint, quality int"), settings=SMALL) for y in (0, 1))
    reader = Q.Features(SMALL)
    assert a.log_odds(reader.of(long[1].encode())) < b.log_odds(reader.of(long[1].encode()))
