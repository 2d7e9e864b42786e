"""Graph operators on small graphs of our own and against union-find."""

import random

import numpy as np

from pyspark.sql import functions as F

from tessera.operators import graph as G

# A triangle 10-20-30 with a way on to 40, 50, 60; the pair 80-90; 70 alone.
# An edge goes from somebody to a follower; two people are called ann.
EDGES = [(10, 20), (20, 30), (30, 10), (50, 10), (30, 40), (40, 50), (60, 50), (90, 80)]
PEOPLE = [(10, "ann"), (20, "bob"), (30, "cid"), (40, "dee"), (50, "eli"), (60, "fay"), (70, "gus"), (80, "hal"), (90, "ann")]
# harbor: .1-.2 by user 11, .2-.3 by user 12, .9 apart; library: two places nobody
# shares; one row without a network
LOG = [(11, "harbor", "u4pru", "10.0.0.1", 3), (11, "harbor", "u4prv", "10.0.0.2", 4), (12, "harbor", None, "10.0.0.3", 4),
       (12, "harbor", None, "10.0.0.2", 6), (13, "harbor", None, "10.0.0.9", 1), (11, "library", "u4pr2", "10.0.0.1", 2),
       (14, "library", None, "10.9.0.7", 2), (15, None, None, "10.0.0.5", 5)]
CLUSTERS = [[("harbor", "10.0.0.1"), ("harbor", "10.0.0.2"), ("harbor", "10.0.0.3")], [("harbor", "10.0.0.9")],
            [("library", "10.0.0.1")], [("library", "10.9.0.7")]]
# two networks join p1..p3, one only p4, two join p5..p7, p8 has none
PAIRS = [("p1", "n1"), ("p2", "n1"), ("p2", "n2"), ("p3", "n2"), ("p4", "n3"), ("p5", "n4"), ("p6", "n4"), ("p6", "n5"),
         ("p7", "n5"), ("p8", None)]


def edges_df(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def comp_map(df):
    return {r["id"]: r["component"] for r in df.collect()}


def test_components_of_people(spark):
    v = spark.createDataFrame(PEOPLE, "id bigint, name string")
    c = comp_map(G.connected_components(v, edges_df(spark, EDGES)))
    assert c == {10: 10, 20: 10, 30: 10, 40: 10, 50: 10, 60: 10, 70: 70, 80: 80, 90: 80}


def test_edges_with_a_null_end_link_nothing(spark):
    c = comp_map(G.connected_components(None, edges_df(spark, [(1, 2), (3, None), (None, 2), (None, None)])))
    assert c == {1: 1, 2: 1, 3: 3}


def test_component_members(spark):
    v = spark.createDataFrame([(i,) for i in (4, 6, 8, 14, 15, 21)], "id bigint")
    m = G.component_members(G.connected_components(v, edges_df(spark, [(8, 6), (6, 4), (15, 14)])))
    assert sorted(map(tuple, m.collect())) == [(4, 3, "4"), (4, 3, "6"), (4, 3, "8"), (14, 2, "14"), (14, 2, "15"), (21, 1, "21")]


def _union_find(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    out = {}
    for i in range(n):
        r = find(i)
        out[i] = r
    # component id = smallest member
    mins = {}
    for i, r in out.items():
        mins[r] = min(mins.get(r, i), i)
    return {i: mins[out[i]] for i in range(n)}


def test_components_match_union_find(spark):
    rnd = random.Random(7)
    for n, m in ((40, 30), (60, 80), (30, 5)):
        pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]
        chain = [(i, i + 1) for i in range(n, n + 25)]  # a long path needs many rounds
        v = spark.createDataFrame([(i,) for i in range(n + 26)], "id bigint")
        got = comp_map(G.connected_components(v, edges_df(spark, pairs + chain)))
        assert got == _union_find(n + 26, pairs + chain)


def test_bounded_components_hops(spark):
    chain = [(i, i + 1) for i in range(10)]
    got = comp_map(G.bounded_components(None, edges_df(spark, chain), 3))
    assert got == {i: max(0, i - 3) for i in range(11)}


def test_bounded_group_equals_clique_edges(spark):
    rnd = random.Random(3)
    groups = [[rnd.randrange(30) for _ in range(rnd.randrange(1, 5))] for _ in range(15)]
    mem = spark.createDataFrame([(n, g) for g, ns in enumerate(groups) for n in ns], "node bigint, grp int")
    nodes = spark.createDataFrame([(i,) for i in range(30)], "node bigint")
    a = {r["node"]: r["component"] for r in G.bounded_group_components(nodes, mem, 2).collect()}
    pairs = [(x, y) for ns in groups for x in ns for y in ns if x < y]
    v = spark.createDataFrame([(i,) for i in range(30)], "id bigint")
    b = comp_map(G.bounded_components(v, edges_df(spark, pairs or [(0, 0)]), 2))
    assert a == b


def test_neighbor_mean(spark):
    # 10 hears from 30 and 50, 50 from 60, 80 from 90; nobody else from a greater one
    v = spark.createDataFrame([(i, float(i)) for i, _ in PEOPLE], "id bigint, attr double")
    got = {r["id"]: r["mean"] for r in G.neighbor_mean(v, edges_df(spark, EDGES)).collect()}
    assert got == {10: 40.0, 50: 60.0, 80: 90.0}


def test_influence(spark):
    v = spark.createDataFrame(PEOPLE, "id bigint, name string")
    scores = G.influence(v, edges_df(spark, EDGES))
    got = {r["id"]: r["influence"] for r in scores.collect()}
    # e.g. 30 is followed by 10 and 40, those by 20 and 50: ann, dee, bob, eli
    assert got == {10: 2, 20: 3, 30: 4, 40: 2, 50: 2, 60: 2, 70: -1, 80: -1, 90: 1}
    assert [r["id"] for r in G.top_influencer(scores, 4).collect()] == [30, 20, 10, 40]


def _sets(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["set_id"], {}).setdefault(r["kind"], set()).add(r["member"])
    return out


def test_id_sets(spark):
    got = _sets(G.reduce_id_sets(spark.createDataFrame(PAIRS, "uid string, wifi string")))
    assert got == {
        1: {"uid": {"p1", "p2", "p3"}, "wifi": {"n1", "n2"}, "merged": {"1", "2", "3"}},
        4: {"uid": {"p4"}, "wifi": {"n3"}, "merged": {"4"}},
        5: {"uid": {"p5", "p6", "p7"}, "wifi": {"n4", "n5"}, "merged": {"5", "6", "7"}},
        8: {"uid": {"p8"}, "merged": {"8"}},
    }


def test_id_sets_chain_is_one_set(spark):
    pairs = [("a", "x"), ("b", "x"), ("b", "y"), ("c", "y"), ("d", "y"), ("d", "z"), ("e", "z")]
    assert set(_sets(G.reduce_id_sets(spark.createDataFrame(pairs, "uid string, wifi string")))) == {1}


def test_id_sets_by_brute_force_without_second_passes(spark, monkeypatch):
    """Pairs are distinct and numbers vertices already: neither is made anew, and a wifi's
    set comes from one of its numbers."""
    def unused(*args, **kwargs):
        raise AssertionError("a pass over all pairs too many")

    monkeypatch.setattr(G, "cooccurrence_edges", unused)
    monkeypatch.setattr(G, "connected_components", unused)
    pairs = [(f"p{i * 7 % 40}", f"n{i * i % 61}") for i in range(90)] * 2 + [("hot", f"n{i}") for i in range(3)] + [("alone", None), (None, "n1"), (None, "n99")]
    pairs += [(f"q{i}", "crowd") for i in range(200)]
    uids = sorted({u for u, _ in pairs if u})
    parent = {u: u for u in uids}

    def root(u):
        while parent[u] != u:
            u = parent[u]
        return u

    first = {}
    for u, w in pairs:
        if u and w:
            a, b = sorted((root(u), root(first.setdefault(w, u))))
            parent[b] = a
    want = {}
    for u, w in pairs:
        if u:
            number = uids.index(root(u)) + 1
            held = want.setdefault(number, {"uid": set(), "merged": set()})
            held["uid"].add(u)
            held["merged"].add(str(uids.index(u) + 1))
            if w:
                held.setdefault("wifi", set()).add(w)
    out = G.reduce_id_sets(spark.createDataFrame(pairs, "uid string, wifi string"))
    assert _sets(out) == want and out.count() == sum(len(m) for s in want.values() for m in s.values())


def _actions(spark):
    rows = [(*r, None, i) for i, r in enumerate(LOG)]
    return spark.createDataFrame(rows, "uid bigint, wifi_name string, geohash string, ip string, day_num int, "
                                       "bssid string, vid bigint")


def test_map_wifi_ids(spark):
    out = G.map_wifi_ids(_actions(spark).drop("bssid", "vid"), ordered=True)
    first = [tuple(r[:4]) for r in out.collect()]
    assert first == sorted(first, key=lambda r: [(x is not None, x) for x in r])
    clusters = {}
    for r in out.where("wifi_name IS NOT NULL").collect():
        clusters.setdefault(r["vertex_id"], set()).add((r["wifi_name"], r["ip"]))
    assert sorted(sorted(c) for c in clusters.values()) == CLUSTERS
    assert [r["vertex_id"] for r in out.where("wifi_name IS NULL").collect()] == [None]


def test_recognize_wifi(spark):
    out = G.recognize_wifi(_actions(spark), "20240229", 6).collect()
    ids = {}
    for r in out:
        ids.setdefault(r["wifi_id"], set()).add((r["wifi_name"], r["ip"]))
    # clusters are named by their first row, the row without a network by its own
    assert {k: sorted(v, key=str) for k, v in ids.items()} == {**dict(zip("0456", CLUSTERS)), "7": [(None, "10.0.0.5")]}
    assert all(r["date_p"] == "20240229" for r in out)
    with_bssid = _actions(spark).withColumn("bssid", F.lit("ab"))
    assert {r["wifi_id"] for r in G.recognize_wifi(with_bssid, "d", 6).collect()} == {"ab"}


def test_cooccurrence_is_star(spark):
    df = spark.createDataFrame([("g", i) for i in (5, 3, 9, 3)], "g string, id bigint")
    e = sorted((r["src"], r["dst"]) for r in G.cooccurrence_edges(df, ["g"], "id").collect())
    assert e == [(3, 5), (3, 9)]


def test_contraction_keeps_components(spark, monkeypatch):
    rng = random.Random(31)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(-3, 7), (2**60, 5)]

    def classes(pairs):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x
        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {x: find(x) for x in root}

    a, b = (np.array(c, np.int64) for c in zip(*edges))
    x, y = G.star_forest(a, b)
    want = classes(edges)
    assert dict(zip(x.tolist(), y.tolist())) == {v: r for v, r in want.items() if v != r}
    monkeypatch.setattr(G, "_AT_ONCE", 10)  # in many portions
    df = spark.createDataFrame(edges, "x bigint, y bigint").repartition(3)
    got = [(r["x"], r["y"]) for r in G.contract(df).collect()]
    assert {v: r for v, r in classes(got).items() if v != r} == {v: r for v, r in want.items() if v != r} and len(got) <= len(edges)


def test_bounded_rounds_send_what_changed(spark):
    n = 400
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(1, n)]  # a chain and a star
    e = spark.createDataFrame(edges, "src bigint, dst bigint")
    v = spark.createDataFrame([(9999,)], "id bigint")
    for rounds in (0, 1, 3, 8):
        sent = []
        got = {r["id"]: r["component"] for r in G.bounded_components(v, e, rounds, sent=sent).collect()}
        assert got[9999] == 9999 and all(got[i] == max(0, i - rounds) for i in range(61))
        assert all(got[100 + i] == (100 if rounds else 100 + i) for i in range(1, n))
        # first all labels, then those that moved: the star is done after one round
        assert sent == [n + 61, n - 1 + 60, *(61 - k for k in range(2, rounds))][:rounds]
