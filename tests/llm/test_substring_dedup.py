import hashlib
import random

import numpy as np
import pytest

from tessera.llm import substring_dedup as B

from .helpers import WORDS, clash, frame, prose


def brute(rows, window):
    words = {i: WORDS.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k:k + window]), i)
    out = {}
    for i, ws in words.items():
        gone = set()
        for k in range(len(ws) - window + 1):
            if first[tuple(ws[k:k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = (len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone))
    return out


def corpus(window):
    rng = random.Random(4)
    shared = [prose(rng, rng.randrange(window // 2, 4 * window)) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += [prose(rng, rng.randrange(0, window + 10)), rng.choice(shared)]
        rows.append((i * 3, rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(i * 3 + 1, rows[rng.randrange(60)][1]) for i in range(10)]  # whole copies
    rows += [(5000, "same " * (3 * window)), (5001, "same " * window), (5002, "same " * (window - 1)), (5003, None), (5004, ""),
             (5005, "a\x1cb c " * window), (5006, "a\x1cb c " * window), (-4, shared[0]), (6000, prose(rng, 20_000, 5))]
    return rows


@pytest.mark.parametrize("window", [50, 7])
def test_brute_force(spark, window):
    rows = corpus(window)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in B.substring_dedup(frame(spark, rows), window=window).collect()}
    assert got == brute(rows, window)


def test_hashes_do_not_remove_other_words(spark, monkeypatch):
    s, t = clash()
    rows = [(1, f"{s} " * 60), (2, f"{t} " * 60), (3, f"{s} " * 55 + f"{t} " * 55), (4, " ".join([s, t] * 40)), (5, " ".join([t, s] * 40))]
    # the words of the strings as documents: their windows clash if words are digits of a polynomial hash
    rows += [(6, " ".join(s)), (7, " ".join(t)), (8, "x " + " ".join(s[:700]))]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in B.substring_dedup(frame(spark, rows)).collect()}
    assert got == brute(rows, 50) and got[2][1] == 0


def test_equal_hashes_alone_remove_nothing(monkeypatch):
    # all windows made to hash alike: only the digests of their words tell them apart
    monkeypatch.setattr(B, "mix", lambda x: x * 0)
    monkeypatch.setattr(B.WordHashes, "of", lambda self, words: np.zeros(len(words), np.uint64))
    hasher = B.Windows(3)
    words, starts, ends, anchors, hashes = hasher.of(b"a b c d e f")
    assert len(set(anchors.tolist())) == len(set(hashes.tolist())) == 1
    late = [{"hash": 0, "words": d} for d in hasher.digests(b"b c d".split(), np.array([0]), np.array([1]))]
    assert B._removed(hasher, b"a b c d e f", [], late) == [(1, 4)]
    assert B._removed(hasher, b"a b x d e f", [], late) == []
    assert B._removed(hasher, b"a b x d e f", hasher.digests(words, starts, ends).tolist(), []) == []


def test_spans_are_maximal(spark):
    rng = random.Random(5)
    a, b = prose(rng, 60), prose(rng, 60)
    out = B.substring_dedup(frame(spark, [(1, f"{a} x {b}"), (2, f"{a} y {b} tail")])).orderBy("doc_id").collect()
    assert [[tuple(s) for s in r["spans"]] for r in out] == [[], [(0, 60), (61, 121)]]
    assert hashlib.sha256(out[1]["kept_text"].encode()).hexdigest() == hashlib.sha256(b"y tail").hexdigest()


def test_nulls_repeats_and_extra_columns(spark):
    text = prose(random.Random(6), 80)
    schema = "doc_id bigint, text string, anchor int, run string, dead int, hashes string"
    rows = [(None, text, 1, "r", 1, "h"), (2, text, 1, "r", 1, "h"), (2, text, 1, "r", 1, "h"), (3, text, 1, "r", 1, "h")]
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in B.substring_dedup(spark.createDataFrame(rows, schema)).collect())
    assert got == [("2", 0), ("2", 0), ("3", 80), ("None", 0)]
    assert B.substring_dedup(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("other", [None, "", "too short"])
def test_an_id_with_a_long_and_a_short_text(spark, other):
    rng = random.Random(7)
    shared, head, tail = prose(rng, 70), prose(rng, 60), prose(rng, 60)
    rows = [(1, f"{head} {shared}"), (1, other), (2, f"{shared} {tail}"), (2, other), (3, other)]
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in B.substring_dedup(frame(spark, rows)).collect())
    n, kept = len((other or "").split()), other or ""
    assert got == sorted([(1, 130, 0, rows[0][1]), (1, n, 0, kept), (2, 130, 70, tail), (2, n, 0, kept), (3, n, 0, kept)])


def test_long_texts(spark):
    """A text of megabytes: its copy goes, a repeated passage inside one document stays."""
    rng = random.Random(8)
    long = prose(rng, 300_000, 100_000)
    rows = [(1, long), (2, f"start {long}"), (3, "z " * 200_000), (4, "z " * 49 + "end"), (5, "z " * 51)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in B.substring_dedup(frame(spark, rows)).collect()}
    assert got == {1: (300_000, 0), 2: (300_001, 300_000), 3: (200_000, 0), 4: (50, 0), 5: (51, 51)}
