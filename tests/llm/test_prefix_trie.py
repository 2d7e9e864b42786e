import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tessera.llm import prefix_trie as T
from tessera.llm import queries as Q

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def ordered(rows):
    """conv_id -> its turns, as (role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            convs[c].append((turn is not None, turn or 0, mark, role, text))
    return {c: [t[3:] for t in sorted(own)] for c, own in convs.items()}


def brute(convs):
    """Nodes by walking every conversation."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
        ends[tuple(own)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    out = {}
    for p in sorted(members, key=len, reverse=True):
        below = [out[q] for q in children[p]]
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        ids = ",".join(map(str, sorted(ends[p])))
        out[p] = (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]),
                  sum(b[5] for b in below) if below else 1, own + sum(b[6] for b in below), hashlib.sha256(ids.encode()).hexdigest())
    return sorted(out.values(), key=lambda r: (r[1], r[0]))


def nodes(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns[:8] == names
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda r: (r[1], r[0]))


def conversations(rng, n, most=9, ids=None):
    """Few distinct turns, so that many prefixes are shared; every awkward kind of row."""
    rows = []
    for c in ids or rng.sample(range(1000), n):
        for t in range(rng.randrange(1, most)):
            rows.append((c, t, rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b" * 30, "日本é", "", None])))
    rows += [(5, None, "user", "first"), (5, 0, "user", "a"), (5, 0, "user", "a"), (None, 1, "user", "x"), (7, 1, "us", "era"), (7, 0, "user", "a")]
    rng.shuffle(rows)
    return rows


def run(spark, rows):
    turns = T.number_turns(spark.createDataFrame(rows, SCHEMA))
    return nodes(T.prefix_trie(turns))


@pytest.mark.parametrize("seed,n,most", [(1, 60, 9), (2, 5, 2), (3, 12, 40)])
def test_trie_by_brute_force(spark, seed, n, most):
    rows = conversations(random.Random(seed), n, most)
    assert run(spark, rows) == brute(ordered(rows))


def test_one_long_conversation_holds_most_rows(spark):
    rows = [(1, t, "user", f"t{t}" * (t % 3)) for t in range(700)]
    rows += [(c, t, "user", f"t{t}" * (t % 3)) for c in (2, 3) for t in range(c * 20)] + [(4, 0, "user", "other")]
    assert run(spark, rows) == brute(ordered(rows))


def test_many_equal_conversations(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(600) for t in range(3)] + [(c, 0, "user", "t0") for c in range(600, 700)]
    assert run(spark, rows) == brute(ordered(rows))


def test_empty_table_and_turnless_conversations(spark):
    assert run(spark, [(None, 0, "user", "x")]) == [] and run(spark, []) == []
    turns = T.number_turns(spark.createDataFrame([(3, 0, "user", "x")], SCHEMA))
    convs = spark.createDataFrame([(3,), (1,), (2,)], "conv_id bigint")
    assert nodes(T.prefix_trie(turns, convs)) == brute({1: [], 2: [], 3: [("user", "x")]})
    none = T.number_turns(spark.createDataFrame([], SCHEMA))
    assert nodes(T.prefix_trie(none, convs)) == brute({1: [], 2: [], 3: []})


def test_extra_columns_with_clashing_names(spark):
    rows = [(1, 0, "user", "a", 9, "m", 2), (1, 1, "user", "b", 9, "m", 2), (2, 0, "user", "a", 9, "m", 2)]
    df = spark.createDataFrame(rows, SCHEMA + ", pos int, mark string, row int")
    assert nodes(T.prefix_trie(T.number_turns(df))) == brute(ordered([r[:4] for r in rows]))


def test_query_follows_its_contract(spark, tmp_path):
    rng = random.Random(21)
    ids = rng.sample([*range(0, 40), *range(100, 130), *range(201, 230), 300, 301], 70)
    rows = conversations(rng, 0, 9, ids)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    convs = ordered(rows)
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    assert any(not own for own in rebuilt.values())
    assert nodes(Q.op12_prefix_trie(spark, str(tmp_path))) == brute(rebuilt)
