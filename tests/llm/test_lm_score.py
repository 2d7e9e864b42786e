import math
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import lm_score as L

from .helpers import WORDS, clash, frame, prose


def brute(rows, corpus, order, min_count, alpha=0.4):
    counts = Counter()
    for _, t in corpus:
        w = WORDS.findall(t or "")
        for k in range(1, order + 1):
            counts.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    total = max(1, sum(len(WORDS.findall(t or "")) for _, t in corpus))

    def s(context, w):
        if not context:
            return max(counts[(w,)], 0.5) / total
        if counts[(*context, w)] >= min_count:
            # a kept n-gram's context is at least as frequent, so it is kept too
            return counts[(*context, w)] / counts[context]
        return alpha * s(context[1:], w)

    out = []
    for i, t in rows:
        w = WORDS.findall(t or "")
        out.append((i, len(w), math.fsum(math.log(s(tuple(w[max(0, k - order + 1):k]), x)) for k, x in enumerate(w))))
    return out


def close(got, want):
    got = sorted((str(r["doc_id"]), r["n_words"], r["log_score"]) for r in got)
    want = sorted((str(i), n, s) for i, n, s in want)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(math.isclose(g[2], w[2], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want))


def corpus(seed):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(0, 60), 25)) for i in range(60)]
    s, t = clash()  # words that a weak hash takes for one
    rows += [(200, f"{s} {s} {t} w1 {t}"), (201, f"w1 {s} {s} w2")]
    return rows + [(100, None), (101, ""), (102, "one"), (103, "w1 w2"), (104, "é 日本 é 日本"), (None, "w1 w2 w3"), (105, "w1\x1cw2 w3"),
                   (106, "w3 " * 5000), (1, rows[1][1])]


@pytest.mark.parametrize("order,min_count", [(1, 1), (2, 2), (3, 2), (4, 1)])
def test_own_counts(spark, order, min_count):
    rows = corpus(14)
    out = L.lm_score(frame(spark, rows), order=order, min_count=min_count, block_chars=3000).collect()
    close(out, brute(rows, rows, order, min_count))


def test_other_corpus(spark):
    rows, base = corpus(15), corpus(16)[:40]
    out = L.lm_score(frame(spark, rows), corpus=frame(spark, base), block_chars=2000).collect()
    close(out, brute(rows, base, 3, 2))


def test_edges(spark):
    schema = "doc_id bigint, text string, block string, k int, part int"
    assert L.lm_score(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b", "x", 1, 1), (1, "a b", "x", 1, 1)]
    out = L.lm_score(spark.createDataFrame(rows, schema)).collect()
    assert [r["n_words"] for r in out] == [2, 2] and out[0]["mean_log_score"] == out[0]["log_score"] / 2
    empty = L.lm_score(frame(spark, [(1, "a b"), (2, "")]), corpus=frame(spark, [])).collect()
    close(empty, brute([(1, "a b"), (2, "")], [], 3, 2))


def test_packed_hashes():
    rng = np.random.default_rng(0)
    for h in (np.sort(rng.integers(0, 2**64, 1000, dtype=np.uint64)), np.zeros(0, np.uint64), np.array([0, 2**64 - 1], np.uint64)):
        assert (L.unpack(L.pack(h)) == h).all()
        assert (L.unpack_counts(L.pack_counts(np.arange(len(h)))) == np.arange(len(h))).all()
