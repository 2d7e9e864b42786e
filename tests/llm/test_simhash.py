import random

import numpy as np
import pyarrow as pa
import xxhash

from tessera.llm import simhash as S
from tessera.operators.graph import connected_components

from .helpers import WORDS, components, frame, prose


def brute_fingerprint(text, shingle=4):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, bits=4):
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    linked = [(i, j) for i, f in fps for j, g in fps if i is not None and j is not None and i < j and (f ^ g).bit_count() <= bits]
    comp = components({i for i, _ in fps if i is not None}, linked)
    return {(i, f"{f:016x}", comp[i]) for i, f in fps if i is not None}


def corpus():
    rng = random.Random(3)
    rows = []
    for g in range(12):
        base = prose(rng, 150).split()
        for _ in range(8):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = "edit"
            rows.append((len(rows) + 10, " ".join(words)))
    extra = [None, "", " \n", "one", "One", "two words", "a b c d", "A b C d", "İ Été X Y Z", "long " * 30_000, "a\x1cb c d e"]
    return rows + [(i, t) for i, t in enumerate(extra)]


def test_brute_force(spark):
    rows = corpus()
    out = {tuple(r)[:3] for r in S.simhash_dedup(frame(spark, rows + rows[:5])).collect()}
    assert out == brute(rows)


def test_null_ids_and_empty_input(spark):
    assert S.simhash_dedup(frame(spark, [])).count() == 0
    schema = "doc_id bigint, text string, fp int, fingerprint string, key string"
    rows = [(None, "a b c d", 1, "x", "y"), (7, "A B C D", None, None, None), (None, "nothing like it at all", 1, "x", "y")]
    got = sorted((tuple(r) for r in S.simhash_dedup(spark.createDataFrame(rows, schema)).select("doc_id", "component_id", "kept").collect()), key=str)
    assert got == sorted([(None, 7, False), (7, 7, True), (None, None, False)], key=str)


def test_golay_table():
    table = S.nearby_table()
    assert (table >= 0).sum() == 10903  # all patterns of weight 0 to 4
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 500)
    code = S.nearby_codewords(words)
    assert ((code >= 0).any(1)).all() and code.max() < 4096


def test_every_pair_within_four_bits_shares_a_key():
    rng = np.random.default_rng(1)
    for errors in ([0, 0, 4], [1, 3, 0], [2, 1, 1], [2, 2, 0], [4, 0, 0], [0, 1, 3]):
        for _ in range(40):
            a = int(rng.integers(0, 2**64, dtype=np.uint64))
            b = a
            for (at, n), e in zip(S.SEGMENTS, errors):
                for bit in rng.choice(n, e, replace=False):
                    b ^= 1 << (at + int(bit))
            keys, own = S.keys_of(np.array([a, b], np.uint64))
            assert set(keys[own == 0]) & set(keys[own == 1]), errors


def ball(seed, n, centres=3, spread=5):
    rng = np.random.default_rng(seed)
    out = set()
    while len(out) < n:
        x = int(rng.integers(0, 2**64, dtype=np.uint64)) if len(out) < centres else list(out)[int(rng.integers(centres))]
        for b in rng.choice(64, int(rng.integers(0, spread + 1)), replace=False):
            x ^= 1 << int(b)
        out.add(x)
    return sorted(out)


def test_links_connect_what_all_links_connect(spark):
    """Dense groups, with whole groups and with blocks of 16."""
    fps = ball(5, 250)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    want = components(signed, [(a, b) for x, a in zip(fps, signed) for y, b in zip(fps, signed) if a < b and (x ^ y).bit_count() <= 4])
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    for block in (S.BLOCK, 16):
        links = S.links(df, block=block).collect()
        assert all(((r[0] ^ r[1]) & (2**64 - 1)).bit_count() <= 4 for r in links)
        assert components(signed, [tuple(r) for r in links]) == want


def test_runs_in_parts():
    """Groups that straddle batches stay whole; large ones are passed on."""
    keys = np.repeat([1, 2, 3, 9], [3, 40, 2, 5])
    fps = np.arange(50)
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i:i + 4]), pa.array(fps[i:i + 4])], names=["key", "fp"]) for i in range(0, 50, 4)]
    whole, large = {}, {}
    for k, f, is_large in S._runs(iter(batches), 10):
        for x in k.tolist():
            (large if is_large else whole).setdefault(x, 0)
            (large if is_large else whole)[x] += 1
    assert whole == {1: 3, 3: 2, 9: 5} and large == {2: 40}


def test_components_with_a_hub(spark):
    edges = [(0, i) for i in range(1, 400)] + [(1000 + i, 1001 + i) for i in range(30)] + [(5, None)]
    out = connected_components(None, spark.createDataFrame(edges, "src bigint, dst bigint"))
    assert {r["component"]: r["n"] for r in out.groupBy("component").count().withColumnRenamed("count", "n").collect()} == {0: 400, 1000: 31}
