"""Stored positional index: places, directory, splitting of hot words, phrase search."""

import glob
import random

import pyarrow.parquet as pq
import pytest

from tessera.operators import index as I
from tessera.operators import search as S

from .test_text_io import PARAGRAPH


def tokens_of(spark, texts, partitions=3):
    rows = [(i, t.split()) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id bigint, toks array<string>").repartition(partitions, "doc_id")


def corpus(seed=1, n=200):
    rng = random.Random(seed)
    words = ["the"] * 30 + ["of"] * 10 + [f"w{i}" for i in range(40)]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 80)))) for i in range(n)]
    return texts + [(1000, "rare pair stands here the rare pair"), (1000, "the rare pair"), (None, "rare pair"), (1001, "")]


def brute(texts, phrases, first_only):
    out = []
    for p in set(phrases):
        want = p.split()
        for i, t in texts:
            toks = t.split()
            out += [(p, i, k, k + len(want) - 1) for k in range(len(toks) - len(want) + 1) if want and toks[k:k + len(want)] == want]
    if first_only:
        best = {}
        for p, i, s, e in out:
            best[p, i] = min(best.get((p, i), (s, e)), (s, e))
        out = [(p, i, *v) for (p, i), v in best.items()]
    return sorted(out, key=repr)


def test_paragraph(spark, tmp_path):
    docs = spark.createDataFrame([(1, PARAGRAPH)], "doc_id bigint, text string")
    I.write_index(I.number_docs(S.doc_tokens(docs)), str(tmp_path / "ix"))
    words = spark.createDataFrame([("slow",), ("the",), ("absent",)], "word string")
    got = {r["word"]: r["positions"] for r in I.read_index(spark, str(tmp_path / "ix"), words).collect()}
    assert got == {"slow": [1, 16], "the": [10, 15]}
    phrases = spark.createDataFrame([(p,) for p in ["dry goods", "the low harbor", "slow barge", "low barge", "rope night", "the", ""]], "phrase string")
    first = {r["phrase"]: (r["start"], r["end"]) for r in I.search_index(spark, str(tmp_path / "ix"), phrases).collect()}
    assert first == {"dry goods": (5, 6), "the low harbor": (10, 12), "slow barge": (1, 2), "the": (10, 10)}


@pytest.mark.parametrize("bits,per_bucket", [(10, 1 << 27), (2, 300)])
def test_postings_and_phrases_by_brute_force(spark, tmp_path, bits, per_bucket):
    texts = corpus()
    path = str(tmp_path / "ix")
    I.write_index(I.number_docs(tokens_of(spark, texts), bits), path, per_bucket)
    words = spark.createDataFrame([(w,) for w in ("the", "w3", "rare", "none", "the")], "word string")
    got = sorted(((r["word"], r["doc_id"], r["positions"]) for r in I.read_index(spark, path, words).collect()), key=repr)
    want = sorted(((w, i, [k for k, x in enumerate(t.split()) if x == w]) for w in ("the", "w3", "rare") for i, t in texts if w in t.split()), key=repr)
    assert got == want
    counts = {r["word"]: (r["docs"], r["places"]) for r in I.directory(spark, path).collect()}
    assert counts["the"] == (sum("the" in t.split() for _, t in texts), sum(t.split().count("the") for _, t in texts))
    phrases = ["the the", "the of", "of the of", "w1 w2", "rare pair", "rare pair", "the the the the", "pair the", "w5", "none the", "  ", "the  of"]
    df = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    for first_only in (True, False):
        rows = I.search_index(spark, path, df, first_only=first_only).collect()
        assert sorted(((r["phrase"], r["doc_id"], r["start"], r["end"]) for r in rows), key=repr) == brute(texts, phrases, first_only)


def test_a_frequent_word_is_cut_into_blocks_and_files(spark, tmp_path):
    held = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        rng = random.Random(3)
        texts = [(i, "hot " * 60 + f"w{rng.randrange(30)}") for i in range(400)]
        path = str(tmp_path / "ix")
        I.write_index(I.number_docs(tokens_of(spark, texts), 4), path)
        (hot,) = I.directory(spark, path).where("word = 'hot'").collect()
        assert hot["blocks"] >= 400 // 16 and hot["places"] == 24_000
        files = [f for f in glob.glob(f"{path}/postings/bucket=*/*.parquet") if "hot" in pq.read_table(f, columns=["word"])["word"].to_pylist()]
        assert len(files) > 1
        assert I._postings(spark, path).where("word = 'hot'").selectExpr("max(n)").first()[0] <= 16 * 60
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_places_are_stored_as_differences(spark, tmp_path):
    path = str(tmp_path / "ix")
    I.write_index(I.number_docs(tokens_of(spark, [(i, "a b " * 500) for i in range(50)], 1)), path)
    (file,) = glob.glob(f"{path}/postings/bucket=0/*.parquet")
    column = pq.ParquetFile(file).metadata.row_group(0)
    places = next(column.column(i) for i in range(column.num_columns) if "places" in column.column(i).path_in_schema)
    assert "DELTA_BINARY_PACKED" in places.encodings and places.total_uncompressed_size < 2 * places.num_values


def test_search_reads_the_index_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ix")
    I.write_index(I.number_docs(tokens_of(spark, corpus())), path, 100)
    real, plans = I.cut_lineage, []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(I, "cut_lineage", seen)
    found = I.search_index(spark, path, spark.createDataFrame([("rare pair",)], "phrase string"))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert found.count() and not any("toks" in p and "posexplode" in p and "FileScan" not in p for p in plans)
    assert any("bucket" in p.split("PartitionFilters")[1][:60] and "word" in p.split("PushedFilters")[1][:80] for p in plans if "PartitionFilters" in p)
    monkeypatch.setattr(I, "_LISTED", 0)  # more words than are named: a join, the same result
    joined = I.search_index(spark, path, spark.createDataFrame([("rare pair",)], "phrase string"))
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, found.collect()))


def test_empty_corpus(spark, tmp_path):
    path = str(tmp_path / "ix")
    I.write_index(I.number_docs(tokens_of(spark, [(1, "")])), path)
    assert I.search_index(spark, path, spark.createDataFrame([("a b",)], "phrase string")).count() == 0
    assert I.read_index(spark, path, spark.createDataFrame([("a",)], "word string")).count() == 0
