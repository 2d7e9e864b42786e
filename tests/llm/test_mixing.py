import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing as M

from .helpers import prose

SCHEMA = "doc_id bigint, text string, source string"


def docs(spark, seed=12):
    rng = random.Random(seed)
    rows = []
    for source, n in (("big", 400), ("mid", 120), ("small", 30), (None, 20), ("", 10)):
        rows += [(len(rows) + i, prose(rng, rng.randrange(0, 60)), source) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA), rows


def by_source(out):
    got = {}
    for r in out:
        got.setdefault(r["source"], []).append(r)
    return got


def check(got, budget_of):
    """Tokens of each source against its share of the budget."""
    for source, rows in got.items():
        size = sum(r["tokens"] for r in rows)
        goal = budget_of(source, rows)
        used = sum(r["tokens"] * r["copies"] for r in rows)
        left = goal - used
        # nothing beyond the goal; what is left is less than one more document
        assert -1 <= left < max(r["tokens"] for r in rows) + 1, (source, goal, used)
        low = int(goal // size)
        assert {r["copies"] for r in rows} <= {low - 1, low, low + 1}


def test_repetition_limit(spark):
    df, rows = docs(spark)
    out = M.mix(df, M.Target(repetition=3.0)).collect()
    assert len(out) == len(rows) and all(r["tokens"] == max(1, len((rows[r["doc_id"]][1]).split())) for r in out)
    got = by_source(out)
    weight = {s: r[0]["weight"] for s, r in got.items()}
    size = {s: sum(x["tokens"] for x in r) for s, r in got.items()}
    assert math.isclose(sum(weight.values()), 1)
    passes = {s: weight[s] / size[s] for s in got}
    assert math.isclose(max(passes.values()) / min(passes.values()), 3.0, rel_tol=1e-6)
    # one exponent explains all weights
    a = math.log(weight["big"] / weight["small"]) / math.log(size["big"] / size["small"])
    assert math.isclose(math.log(weight["mid"] / weight["small"]) / math.log(size["mid"] / size["small"]), a, rel_tol=1e-6)
    assert min(r["copies"] for r in out) == 1  # no budget: every document is used
    scale = 1 / min(passes.values())
    check(got, lambda s, r: weight[s] * scale)


def test_target_entropy_and_budget(spark):
    df, _ = docs(spark)
    out = M.mix(df, M.Target(entropy=1.2), budget=9000).collect()
    got = by_source(out)
    w = {s: r[0]["weight"] for s, r in got.items()}
    assert math.isclose(-sum(x * math.log(x) for x in w.values()), 1.2, rel_tol=1e-6)
    check(got, lambda s, r: 9000 * w[s])
    assert sum(r["tokens"] * r["copies"] for r in out) <= 9000


def test_partial_pass_follows_the_permutation(spark):
    """Brute force: documents in the order of their keyed hash while the budget lasts."""
    df, rows = docs(spark, 13)
    out = by_source(M.mix(df, M.Target(repetition=1.0), budget=2500).withColumn(
        "u", F.pmod(F.xxhash64("doc_id", F.lit(42)), F.lit(1 << M.ORDER_BITS))).collect())
    for source, rs in out.items():
        size = sum(r["tokens"] for r in rs)
        passes, left = divmod(math.floor(rs[0]["weight"] * 2500 + 1e-6), size)
        for r in sorted(rs, key=lambda r: r["u"]):
            left -= r["tokens"]
            assert r["copies"] == passes + (left >= 0)


def test_unreachable_targets(spark):
    df, _ = docs(spark)
    flat = M.mix(df, M.Target(repetition=1e9)).select("source", "weight").distinct().collect()
    assert all(math.isclose(r["weight"], 0.2) for r in flat)  # exponent 0
    as_is = M.mix(df, M.Target(entropy=0.0)).select("source", "weight", "copies").distinct().collect()
    assert {r["copies"] for r in as_is} == {1}  # exponent 1
    with pytest.raises(ValueError):
        M.Target()


def test_edges(spark):
    schema = SCHEMA + ", key int, u int, tokens string, copies int, n int"
    assert M.mix(spark.createDataFrame([], schema), M.Target(repetition=2)).count() == 0
    rows = [(None, None, None), (1, "a b", "x"), (1, "a b", "x"), (1, "a", "y"), (2, "", "x")]
    df = spark.createDataFrame([r + (0, 0, "t", 0, 0) for r in rows], schema)
    mixed = M.mix(df, M.Target(repetition=1.0))
    assert sorted((str(r["doc_id"]), str(r["source"]), r["tokens"], r["copies"]) for r in mixed.collect()) == [
        ("1", "x", 4, 1), ("1", "y", 1, 1), ("2", "x", 1, 1), ("None", "None", 1, 1)]
    again = M.realise(df, mixed)
    assert again.columns == df.columns and sorted(map(str, again.collect())) == sorted(map(str, df.collect()))
    many = M.realise(df, mixed.withColumn("copies", F.lit(3)))
    assert many.count() == 15
