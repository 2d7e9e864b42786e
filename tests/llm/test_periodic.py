import hashlib
import random
import time
import zlib

import numpy as np

from tessera.llm import periodic as P
from tessera.llm import queries as Q

from .helpers import WORDS, frame, prose


def brute(words, least=12):
    """(start, length, period) by comparing every lag word by word."""
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                out.setdefault((i - q, j - i + q), q)  # lags ascend: the smallest period of a stretch stays
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(rng, n=150):
    out = []
    for _ in range(n):
        size, vocabulary = rng.choice([0, 1, 11, 12, 13, 40, 120]), rng.choice([1, 2, 3, 10, 1000])
        words = [f"w{rng.randrange(vocabulary)}" for _ in range(size)]
        if size and rng.random() < 0.5:
            a, p = rng.randrange(size), 1 + size // rng.randrange(3, 11)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(size)]
        if rng.random() < 0.3:
            words = (words[:7] * rng.randrange(1, 9) + words[:3]) * 2
        out.append(rng.choice([" ", "\t\n"]).join(words))
    return out


def test_runs_by_brute_force(spark):
    rng = random.Random(11)
    rows = list(enumerate(texts(rng))) + [(900, None), (901, ""), (902, " \t\n "), (None, "a " * 20), (903, "a b " * 12), (0, "x " * 12)]
    rng.shuffle(rows)
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed_text"])
           for r in P.find_runs(frame(spark, rows)).collect()]
    want = []
    for i, t in rows:
        words = WORDS.findall(t or "")
        runs = brute(words)
        want.append((i, len(words), runs, brute_collapsed(words, runs)))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_other_lengths_by_brute_force():
    rng = random.Random(12)
    docs = texts(rng, 80)
    for least in (1, 2, 5, 9, 20, 33):
        for t, (words, rows, keep) in zip(docs, P.scan([t.encode() for t in docs], least)):
            assert [tuple(r) for r in rows.tolist()] == brute(t.split(), least)


def test_portions_of_candidates_give_the_same(monkeypatch):
    rng = random.Random(13)
    docs = [t.encode() for t in texts(rng, 60)]
    want = [rows.tolist() for _, rows, _ in P.scan(docs)]
    monkeypatch.setattr(P, "_ROOM", 7)
    assert [rows.tolist() for _, rows, _ in P.scan(docs)] == want


def test_equal_hashes_are_no_equal_words():
    # the Thue-Morse strings of 1024 letters agree in every polynomial hash modulo 2^64 with an odd base
    s = "a"
    while len(s) < 1024:
        s += s.translate(str.maketrans("ab", "ba"))
    t = s.translate(str.maketrans("ab", "ba"))
    (_, rows, _), = P.scan([" ".join([s, t] * 3 + [s, s] * 5).encode()])
    assert [tuple(r) for r in rows.tolist()] == brute([s, t] * 3 + [s, s] * 5)
    words = list(s) + list(t)
    (_, rows, _), = P.scan([" ".join(words).encode()])
    assert [tuple(r) for r in rows.tolist()] == brute(words)


def test_long_texts_take_no_quadratic_time():
    began = time.time()
    for words in (["a"] * 200_000, ["a", "b"] * 100_000, [*["a"] * 500, "b"] * 400, prose(random.Random(1), 200_000).split()):
        (_, rows, _), = P.scan([" ".join(words).encode()])
        assert len(words) > 500 and all(n >= 2 * q for _, n, q in rows.tolist())
    assert time.time() - began < 90  # one pass over all pairs of equal words would take 2 * 10^10 steps a text


def test_empty_table_and_clashing_columns(spark):
    assert P.find_runs(frame(spark, [])).count() == 0
    rows = [(1, "a b " * 8, 5, "x", [1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, collapsed_text string, runs array<int>")
    (r,) = P.find_runs(docs).collect()
    assert (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed_text"]) == (16, [(0, 16, 2)], "a b")


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_follows_its_contract(spark, tmp_path):
    rng = random.Random(14)
    rows = [(i, t, len(t)) for i, t in enumerate(texts(rng, 200))] + [(500, None, 0), (None, "b " * 30, 60)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r.asDict() for r in Q.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) and any(zlib.crc32(str(i).encode()) % 10 == 0 for i, t, _ in rows if t)
    for i, t, _ in rows:
        words = WORDS.findall(t or "")
        words = words if i is None else planted(i, words)
        runs = brute(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert got[i] == {
            "doc_id": i, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": best[1] and 1000 * best[1] // best[2], "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()}


def test_names_are_exact():
    rng = random.Random(15)
    words = np.array([rng.randrange(3) for _ in range(300)])
    doc = np.sort(np.array([rng.randrange(5) for _ in range(300)]))
    for k, (name, places) in enumerate(P.Names(words, doc).levels):
        size = 1 << k
        pieces = {i: (int(doc[i]), tuple(words[i:i + size].tolist())) for i in range(301 - size) if doc[i] == doc[i + size - 1]}
        seen = list(pieces.values())
        assert sorted(places.tolist()) == [i for i, p in pieces.items() if seen.count(p) > 1]
        assert len({name[i] for i in places}) == len({pieces[i] for i in places})
