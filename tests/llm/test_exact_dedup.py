import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm.exact_dedup import exact_dedup

from .helpers import frame

BLANK = re.compile(r"[\x20\x09-\x0D]")


def brute(rows):
    norm = [BLANK.sub("", t or "") for _, t in rows]
    out = []
    for (i, t), n in zip(rows, norm):
        same = [(len(u or ""), j is not None, -(j or 0), j) for (j, u), m in zip(rows, norm) if m == n]
        keep = max(same, key=lambda x: x[:3])[3]
        out.append((i, keep, len(same), keep == i, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, exact_dedup(df).collect()), key=str)


def sample(seed=1):
    rng = random.Random(seed)
    texts = ["", None, " ", "a b", "ab", "a\tb\n", "\x0b\x0c\r", "ü é", "üé", "a b", "a\x1cb", "日本 語", "x" * 50_000]
    rows = [(i, rng.choice(texts)) for i in range(60)]
    rows += [(-5, "a b"), (2**63 - 1, "a  b"), (-2**63, "a  b"), (None, "ab"), (None, "only null"), (None, "a             b")]
    return rows + rows[:3]  # repeated rows


def test_brute_force(spark):
    rows = sample()
    assert result(frame(spark, rows)) == brute(rows)


def test_colliding_digests(spark, monkeypatch):
    """With one digest for all texts, the texts themselves keep groups apart."""
    sha = F.sha2
    rows = sample(2)
    want = [r[:4] for r in brute(rows)]
    monkeypatch.setattr(F, "sha2", lambda c, n: F.substring(sha(c, n), 1, 1))
    assert sorted((r[:4] for r in result(frame(spark, rows))), key=str) == sorted(want, key=str)


def test_hot_text(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(
        F.concat(F.lit("t"), F.col("id"))).alias("text"))
    out = exact_dedup(df)
    assert out.where("group_size = 1000 and keep_id = 0").count() == 1000
    assert out.where("kept").count() == 2001


def test_empty_and_clashing_columns(spark):
    schema = "doc_id bigint, text string, norm string, digest int, keep_id string, kept int"
    assert exact_dedup(spark.createDataFrame([], schema)).count() == 0
    out = exact_dedup(spark.createDataFrame([(1, "a", "x", 1, "k", 0), (2, " a", "y", 2, None, None)], schema))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert {r["keep_id"] for r in out.collect()} == {2}


@pytest.mark.parametrize("word", ["Python", "Pandas", "Arrow"])
def test_no_python_in_the_plan(spark, word):
    plan = exact_dedup(frame(spark, [(1, "a")]).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert word not in plan
