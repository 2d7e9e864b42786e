"""Tokens by lookup, n-grams counted by buckets first, postings made without a shuffle."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.text import index_tokens
from tessera.operators import index as I
from tessera.operators import search as S


def awkward(n=400, seed=5):
    rng = random.Random(seed)
    alphabet = "ab-_'9.é́²İKΣ一\U0001d7d8 \t\n\x0b\x0c\r\x1c\x1f\x85   ​ 　\u0000Z"
    return [None, "", " ", "--a", "_a", "éa", "file-pointer", *("".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(n))]


def test_tokens_by_lookup_are_those_of_the_pattern(spark, monkeypatch):
    monkeypatch.setattr(S._Kept, "room", 50)
    df = spark.createDataFrame(list(enumerate(awkward())), "k int, body string")
    plain = "(?<![^{0}])[^\\p{{L}}\\p{{N}}_{0}]*([a-z]+)[^{0}]*".format("\\t\\n\\x{0B}\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}")
    want = {r["k"]: (r["t"], r["p"]) for r in df.select("k", index_tokens("body").alias("t"), F.regexp_extract_all(F.lower("body"), F.lit(plain), 1).alias("p")).collect()}
    out = S.doc_tokens(df, "k", "body")
    got = {r["doc_id"]: r["toks"] for r in out.collect()}
    assert dict(out.dtypes) == {"doc_id": "int", "toks": "array<string>"}
    assert {k: (t, t) for k, t in got.items()} == want and sum(map(len, filter(None, got.values()))) > 300


def corpus(seed=2, docs=150, words=30):
    rng = random.Random(seed)
    return [None, [], ["a"]] + [[f"w{min(rng.randrange(words), rng.randrange(words))}" for _ in range(rng.randrange(40))] for _ in range(docs)]


def brute(texts, ks):
    out = []
    for n, k in ks.items():
        counts = Counter(" ".join(t[i:i + n]) for t in texts if t for i in range(len(t) - n + 1))
        out += [(n, p, c) for p, c in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]]
    return sorted(out)


@pytest.mark.parametrize("first,at_once", [(4096, 1 << 20), (1, 10), (20, 100)])
@pytest.mark.parametrize("ks", [{2: 5, 3: 3}, {1: 4}, {2: 10_000, 3: 7}])
def test_top_ngrams_by_brute_force(spark, monkeypatch, first, at_once, ks):
    monkeypatch.setattr(S, "_FIRST", first)
    monkeypatch.setattr(S, "_AT_ONCE", at_once)
    texts = corpus()
    df = spark.createDataFrame([(t,) for t in texts], "toks array<string>").repartition(3)
    assert sorted(tuple(r) for r in S.top_ngrams_multi(df, ks).collect()) == brute(texts, ks)
    n, k = max(ks.items())
    assert [tuple(r) for r in S.top_ngrams(df, n, k).collect()] == sorted([x[1:] for x in brute(texts, {n: k})], key=lambda x: (-x[1], x[0]))


def test_all_ngrams_alike_are_all_counted(spark, monkeypatch):
    monkeypatch.setattr(S, "_FIRST", 2)
    texts = [[f"w{i}", f"w{i + 1}"] for i in range(50)]
    df = spark.createDataFrame([(t,) for t in texts], "toks array<string>")
    assert sorted(tuple(r) for r in S.top_ngrams_multi(df, {2: 3}).collect()) == brute(texts, {2: 3})
    assert S.top_ngrams_multi(df.where("size(toks) = 0"), {2: 3}).count() == 0


def test_few_ngrams_are_counted_by_their_text(spark, monkeypatch):
    seen, real = [], S._counted
    monkeypatch.setattr(S, "_FIRST", 4)
    monkeypatch.setattr(S, "_counted", lambda df, wanted: seen.append(wanted) or real(df, wanted))
    texts = [["of", "the"] * 20 + [f"x{i}", f"y{i}"] for i in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "toks array<string>")
    assert sorted(tuple(r) for r in S.top_ngrams_multi(df, {2: 2}).collect()) == brute(texts, {2: 2})
    assert len(seen) == 1 and seen[0][2].sum() == 4


@pytest.mark.parametrize("at_once", [1 << 21, 7])
def test_postings_need_no_shuffle(spark, monkeypatch, at_once):
    monkeypatch.setattr(I, "_AT_ONCE", at_once)
    texts = corpus(seed=4)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, toks array<string>").repartition(2)
    numbered = I.number_docs(df, 3)
    rows = I.postings(numbered)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    got = rows.collect()
    want = {(w, r["block"], r["slot"] << 32 | i) for r in numbered.collect() for i, w in enumerate(r["toks"] or [])}
    assert sorted((r["word"], r["block"], p) for r in got for p in r["places"]) == sorted(want)
    for r in got:
        assert r["places"] == sorted(r["places"]) and r["n"] == len(r["places"]) and r["n_docs"] == len({p >> 32 for p in r["places"]})
    if at_once > 7:
        assert len({(r["word"], r["block"]) for r in got}) == len(got)
    assert np.all([r["n"] > 0 for r in got])
