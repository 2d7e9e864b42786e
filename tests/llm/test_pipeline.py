import math
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as C  # noqa: E402
from tessera.llm import quality  # noqa: E402
from tessera.llm.queries import PIECES, QUERIES  # noqa: E402
from tessera.sources.tables import table  # noqa: E402

from . import test_exact_dedup, test_simhash  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary file")


def test_stages_against_brute_force(spark):
    """Each stage on what the one before it kept."""
    docs = table(spark, SF, "documents")
    names = docs.columns
    held = []
    for i, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF)
        if i < len(C.STAGES) - 1:
            assert out.columns == names, name
        path = tempfile.mkdtemp(prefix="stage-") + "/out"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        held.append([r.asDict() for r in docs.collect()])
    start = {r["doc_id"]: r.asDict() for r in table(spark, SF, "documents").collect()}
    by_quality, exact, near, mixed, encoded = held
    # quality: the classifier's own decision, recomputed without Spark
    model = quality.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    features = quality.Features(model.settings)
    keep = {i for i, r in start.items() if 1 / (1 + math.exp(-model.log_odds(features.of((r["text"] or "").encode())))) >= C.THRESHOLD}
    assert {r["doc_id"] for r in by_quality} == keep and all(r == start[r["doc_id"]] for r in by_quality)
    want = {i for i, _, _, kept, _ in test_exact_dedup.brute([(r["doc_id"], r["text"]) for r in by_quality]) if kept}
    assert {r["doc_id"] for r in exact} == want and len(exact) == len(want)
    want = {i for i, _, c in test_simhash.brute([(r["doc_id"], r["text"]) for r in exact]) if i == c}
    assert {r["doc_id"] for r in near} == want and len(near) == len(want)
    assert {r["doc_id"] for r in mixed} == want and len(mixed) >= len(near)  # nobody is left out
    assert sorted(r["doc_id"] for r in encoded) == sorted(r["doc_id"] for r in mixed) and all(r["exact"] for r in encoded)


def test_run(spark):
    out = C.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids", "exact"] and out.where("not exact").count() == 0


def test_empty_table_and_null_rows(spark):
    schema = table(spark, SF, "documents").schema
    for rows in ([], [(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0), (2, "a b c", "en", "s", 5)]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in C.STAGES:
            docs = stage(spark, docs, SF)
            assert docs.count() <= max(4, 2 * len(rows)), name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    out = QUERIES[name].build(spark, SF)
    n = table(spark, SF, "embeddings" if name == "op3_embedding_dedup" else "documents").count()
    assert out.count() == n


def test_dedup_stages_decide_by_row(spark):
    """Repeated and NULL ids: one row of each group remains."""
    schema = table(spark, SF, "documents").schema
    a, b, c = ("".join(f"{w}{i} " for i in range(60)) for w in ("alpha", "beta", "gamma"))
    null, seven = [(None, a, "en", "s", 1)] * 300, [(7, b, "en", "s", 1)] * 300
    rows = [*null, *seven, (7, c, "en", "s", 2), (3, c, "en", "s", 2), (None, c + " ", "en", "s", 2), (None, c, "en", "s", 2)]
    docs = spark.createDataFrame(rows, schema)
    exact = C.exact_stage(spark, docs, SF)
    assert sorted(map(str, exact.collect())) == sorted(map(str, spark.createDataFrame([null[0], seven[0], rows[-2]], schema).collect()))
    assert exact.columns == docs.columns
    near = C.near_stage(spark, docs, SF)
    assert sorted(map(str, near.collect())) == sorted(map(str, spark.createDataFrame([null[0], seven[0], rows[-3]], schema).collect()))
    assert near.columns == docs.columns
