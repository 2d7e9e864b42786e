"""Graph operators as DataFrame jobs (GRF-01 .. GRF-10).

A graph is two DataFrames: ``vertices(id bigint, ...)`` and
``edges(src bigint, dst bigint, ...)``.  GraphX is not reachable from
Python, so every algorithm is a loop of joins and aggregations.

Scale notes
-----------
* Connected components use the large-star / small-star alternation (Kiveris
  et al., "Connected Components in MapReduce and Beyond", SoCC 2014): about
  O(log^2 n) rounds on any graph, where plain label propagation needs as many
  rounds as the diameter.  Each round is two ``groupBy(min)`` (partial
  aggregation, so a hub vertex is pre-reduced map-side) and two joins on the
  vertex id in which the few vertices above |E| / partitions are looked up by
  broadcast (see ``skew``), so a hub's rows stay where they are.  The edge set never grows:
  both steps only re-point edges, so the work per round is O(|E|).
* Every round's edges are written as Parquet to the shared folder named by
  ``spark.checkpoint.dir``, and those of the round before removed: lineage stays
  one round deep and a lost executor costs one round, not the whole loop.
* Convergence is one aggregate per round ("is the edge set a star forest?").
* Before the first round and after each, every task contracts the edges it holds,
  a million at a time, to a star forest with the same components (``contract``):
  fewer edges are shuffled and paths are short, so fewer rounds are needed.
* Groups of co-occurring ids are never expanded into all pairs: for
  components a spanning star (group minimum -> every other member) is
  enough, and bounded label propagation over cliques is done through the
  group itself (node -> group minimum -> node), which is exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import name_id
from ..session import checkpoint_dir, cut_lineage
from .skew import join_counted, small, width
from ..sources.sinks import global_row_number, remove_path

# ---------------------------------------------------------------- basics ---

def graph(vertices: DataFrame, edges: DataFrame, default=None, attr: str = "attr") -> DataFrame:
    """GRF-01: vertex table extended by ids that only occur in edges, which
    get ``default`` as attribute.  Returns ``(id, attr)``."""
    ends = (edges.select(F.col("src").alias("id"))
            .unionByName(edges.select(F.col("dst").alias("id"))).distinct())
    v = vertices.select("id", F.col(attr).alias("_a"))
    vid = v.select("id").unionByName(ends).distinct()
    return (vid.join(v, "id", "left")
               .select("id", F.coalesce("_a", F.lit(default)).alias(attr)))


def undirected(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Canonical undirected edge set ``(x, y)`` with ``x > y``: no self
    loops, no duplicates."""
    return (edges.select(F.greatest(src, dst).alias("x"), F.least(src, dst).alias("y"))
                 .where(F.col("x") != F.col("y")).distinct())


def _pointed(rows: DataFrame, lookup: DataFrame, key: str, n: int, hubs: bool) -> DataFrame:
    """Rows joined with the minimum of their key; ``hubs``: some key may hold
    more than a partition's share."""
    return join_counted(rows, lookup, key, "deg", n) if hubs else rows.join(lookup.hint("merge"), key)


def _large_star(e: DataFrame, n: int, hubs: bool) -> DataFrame:
    sym = (e.select(F.col("x").alias("u"), F.col("y").alias("v"))
            .unionByName(e.select(F.col("y").alias("u"), F.col("x").alias("v"))))
    m = sym.groupBy("u").agg(F.min("v").alias("mv"), F.count(F.lit(1)).alias("deg"))
    m = m.select("u", F.least("u", "mv").alias("m"), "deg")
    # no de-duplication here: the output is at most |sym| rows and the
    # small-star step that follows removes duplicates in its final distinct
    return (_pointed(sym.where(F.col("v") > F.col("u")), m, "u", 2 * n, hubs)
            .select(F.col("v").alias("x"), F.col("m").alias("y")))


def _small_star(e: DataFrame, n: int, hubs: bool) -> DataFrame:
    m = e.groupBy("x").agg(F.min("y").alias("m"), F.count(F.lit(1)).alias("deg"))
    moved = (_pointed(e, m, "x", n, hubs).where(F.col("y") != F.col("m"))
             .select(F.col("y").alias("x"), F.col("m").alias("y")))
    return moved.unionByName(m.select("x", F.col("m").alias("y"))).distinct()


_AT_ONCE = 1 << 20


def star_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of some edges as stars: every vertex that is not the least of
    its component, and the least."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, parent = at[:len(a)], at[len(a):], np.arange(len(ids))
    while True:
        up, down = np.maximum(parent[a], parent[b]), np.minimum(parent[a], parent[b])
        apart = up != down
        if not apart.any():
            break
        np.minimum.at(parent, up[apart], down[apart])
        while (parent[parent] != parent).any():
            parent = parent[parent]
    moved = np.flatnonzero(parent != np.arange(len(ids)))
    return ids[moved], ids[parent[moved]]


def contract(e: DataFrame) -> DataFrame:
    """Edges ``(x, y)`` -> star forests, ``_AT_ONCE`` edges of a task at a time; the
    components stay.  Nothing is shuffled."""
    def stars(held):
        x, y = (np.concatenate(c) for c in zip(*held))
        x, y = star_forest(x, y)
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])

    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append([b.column(i).to_numpy(zero_copy_only=False) for i in range(2)])
            n += b.num_rows
            if n >= _AT_ONCE:
                yield stars(held)
                held, n = [], 0
        if n:
            yield stars(held)

    return e.select(F.col("x").cast("bigint"), F.col("y").cast("bigint")).mapInArrow(run, "x bigint, y bigint")


def _state(e: DataFrame) -> tuple[bool, int]:
    """Whether ``e`` is a star forest (every child has one parent and no
    parent is a child: then each star is a component whose centre is its
    smallest id), and the largest degree."""
    roles = (e.select(F.col("x").alias("n"), F.lit(1).alias("c"), F.lit(0).alias("p"))
              .unionByName(e.select(F.col("y").alias("n"), F.lit(0).alias("c"), F.lit(1).alias("p"))))
    each = roles.groupBy("n").agg(F.sum("c").alias("c"), F.max("p").alias("p"), F.count(F.lit(1)).alias("deg"))
    bad = (F.col("c") > 1) | ((F.col("c") >= 1) & (F.col("p") == 1))
    r = each.agg(F.max(bad.cast("int")), F.max("deg")).first()
    return not r[0], r[1] or 0


def _packed(e: DataFrame) -> tuple[DataFrame, str]:
    """Edges written to the shared checkpoint folder as Parquet, which packs numbers to a
    fraction of a checkpoint's rows, and their path."""
    path = f"{checkpoint_dir(e.sparkSession).rstrip('/')}/edges-{uuid.uuid4().hex}"
    e.write.parquet(path)
    return e.sparkSession.read.schema(e.schema).parquet(path), path


def component_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Parent pointers ``(x, y)``: every non-root vertex that has an edge ->
    smallest id of its component (roots do not appear as ``x``).  Edges with
    a NULL end link nothing.  Loops until nothing moves; the potential (sum of
    pointers) falls every round, so it always ends."""
    links = edges.select(F.col(src).cast("bigint").alias("x"), F.col(dst).cast("bigint").alias("y"))
    # contracted where they lie, before the first shuffle
    e, at = _packed(undirected(contract(links.where(F.col("x") != F.col("y"))), "x", "y"))
    n = e.count()
    done, top = _state(e)
    while not done:
        hubs = top > n // width(e)
        large, between = _packed(_large_star(e, n, hubs))
        e, to = _packed(contract(_small_star(large, n, hubs)))
        for path in (at, between):
            remove_path(e.sparkSession, path)
        at, n = to, e.count()
        done, top = _state(e)
    return e


def connected_components(vertices: DataFrame | None, edges: DataFrame, src: str = "src",
                         dst: str = "dst", id_col: str = "id") -> DataFrame:
    """GRF-02: ``(id, component)``, component = smallest id reachable.
    Vertices without edges keep their own id; an edge with a NULL end
    contributes its other end only."""
    parents = component_edges(edges, src, dst)
    ids = (edges.select(F.col(src).alias("id")).unionByName(edges.select(F.col(dst).alias("id"))))
    if vertices is not None:
        ids = ids.unionByName(vertices.select(F.col(id_col).alias("id")))
    ids = ids.where(F.col("id").isNotNull()).distinct()
    return (ids.join(parents.select(F.col("x").alias("id"), F.col("y").alias("p")).hint("merge"), "id", "left")
               .select("id", F.coalesce("p", "id").alias("component")))


def bounded_components(vertices: DataFrame | None, edges: DataFrame, max_iter: int = 6,
                       src: str = "src", dst: str = "dst", id_col: str = "id", sent: list[int] | None = None) -> DataFrame:
    """GRF-03: exactly ``max_iter`` rounds of min-label propagation, so a
    vertex gets the smallest id within ``max_iter`` hops (the bounded
    component semantics; long chains stay unconverged on purpose).

    Semi-naive: a round sends only the labels that the last one changed, and keeps
    only the new ones, so late rounds cost what they change.  A frontier within
    Spark's broadcast bound is sent to the edges where they lie.  ``sent`` gets
    the number of labels that each round sends."""
    sym = (undirected(edges, src, dst).select(F.col("x").alias("u"), F.col("y").alias("v")))
    sym = cut_lineage(sym.unionByName(sym.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    ids = sym.select(F.col("u").alias("id"))
    if vertices is not None:
        ids = ids.unionByName(vertices.select(F.col(id_col).alias("id")))
    ids = cut_lineage(ids.distinct())
    # a vertex's label is the least of its id and of what the rounds brought
    brought = None
    frontier = cut_lineage(sym.select(F.col("u").alias("id")).distinct().withColumn("label", F.col("id")))
    for _ in range(max_iter):
        n = frontier.count()
        if sent is not None:
            sent.append(n)
        if not n:
            break
        told = sym.join(small(frontier.select(F.col("id").alias("v"), "label"), n, 16), "v").where(F.col("label") < F.col("u"))
        news = told.groupBy(F.col("u").alias("id")).agg(F.min("label").alias("label"))
        if brought is not None:
            best = brought.groupBy("id").agg(F.min("label").alias("best"))
            news = news.join(best, "id", "left").where(F.col("best").isNull() | (F.col("label") < F.col("best"))).drop("best")
        frontier = cut_lineage(news)
        brought = frontier if brought is None else brought.unionByName(frontier)
    if brought is None:
        return ids.select("id", F.col("id").alias("component"))
    best = brought.groupBy("id").agg(F.min("label").alias("best"))
    return ids.join(best, "id", "left").select("id", F.coalesce("best", "id").alias("component"))


def bounded_group_components(nodes: DataFrame, membership: DataFrame, max_iter: int = 6) -> DataFrame:
    """Bounded propagation over implicit cliques.

    ``membership(node, grp)`` says node belongs to group ``grp``; every group
    stands for a clique among its nodes.  One round over the clique edges is
    ``label(v) = min(label(v), min over groups g of v of min label in g)`` --
    two aggregations through the group, never the pairs.  ``nodes(node)``
    lists all vertices (isolated ones keep their id).  Returns
    ``(node, component)``.
    """
    mem = cut_lineage(membership.select("node", "grp").distinct())
    n = mem.count()
    lab = cut_lineage(nodes.select("node").distinct().select("node", F.col("node").alias("component")))
    deg = cut_lineage(mem.groupBy("node").agg(F.count(F.lit(1)).alias("deg")))
    for _ in range(max_iter):
        here = join_counted(mem, lab.join(deg, "node"), "node", "deg", n)
        gmin = here.groupBy("grp").agg(F.min("component").alias("g"), F.count(F.lit(1)).alias("size"))
        nmin = join_counted(mem, cut_lineage(gmin), "grp", "size", n).groupBy("node").agg(F.min("g").alias("nl"))
        lab = cut_lineage(lab.join(nmin, "node", "left")
                             .select("node", F.least("component", F.coalesce("nl", "component")).alias("component")))
    return lab


# ------------------------------------------------------- co-occurrence ---

def cooccurrence_edges(df: DataFrame, group_cols: Sequence[str], id_col: str) -> DataFrame:
    """GRF-04 (re-aimed): ids that share a group are connected.

    The reference emits every pair of a group (n(n-1)/2 edges); a spanning
    star -- group minimum -> each other member -- has the same connected
    components with n-1 edges and no per-group collect.  Output
    ``(group..., src, dst)`` with ``src`` the group minimum.
    """
    g = list(group_cols)
    ids = df.where(F.col(id_col).isNotNull()).select(*g, F.col(id_col).alias("dst")).distinct()
    ids = cut_lineage(ids)
    mins = ids.groupBy(*g).agg(F.min("dst").alias("src"), F.count(F.lit(1)).alias("_n"))
    return (join_counted(ids, mins, g, "_n", ids.count()).where(F.col("dst") != F.col("src"))
            .select(*g, "src", "dst"))


# --------------------------------------------------------- id sets ---

def reduce_id_sets(pairs: DataFrame, uid: str = "uid", wifi: str = "wifi") -> DataFrame:
    """GRF-05: uid<->wifi pairs -> disjoint identity sets, long form.

    Initial sets: one per uid, numbered 1, 2, ... in uid order (WIN-07, done
    with a distributed row number).  Sets sharing a wifi merge (true
    connected components -- the reference's loop can leave overlapping sets,
    Q6).  The merged set is named by its smallest initial id.  Output rows
    ``(set_id, kind, member)`` with kind ``uid`` / ``wifi`` / ``merged``;
    the long form keeps a giant set spread over many tasks.
    """
    p, pairs_at = _packed(pairs.select(F.col(uid).alias("uid"), F.col(wifi).alias("wifi")).where(F.col("uid").isNotNull()).distinct())
    uids = global_row_number(p.select("uid").distinct(), ["uid"], out="sid")
    # distinct as they are: a uid has one number
    ps, numbered_at = _packed(p.where(F.col("wifi").isNotNull()).join(uids, "uid").select("sid", "wifi"))
    # a wifi's sets all become one, so its least number tells which
    least = cut_lineage(ps.groupBy("wifi").agg(F.min("sid").alias("least"), F.count(F.lit(1)).alias("_n")))
    linked = join_counted(ps, least, "wifi", "_n", ps.count()).where(F.col("sid") != F.col("least"))
    parents = component_edges(linked, "least", "sid")
    # every uid with its number and set: uids and numbers are members as they are
    named = cut_lineage(uids.join(parents.select(F.col("x").alias("sid"), F.col("y").alias("parent")).hint("merge"), "sid", "left")
                        .select("uid", "sid", F.coalesce("parent", "sid").alias("set_id")))
    for path in (pairs_at, numbered_at):
        remove_path(p.sparkSession, path)
    members_uid = named.select("set_id", F.lit("uid").alias("kind"), F.col("uid").cast("string").alias("member"))
    merged = named.select("set_id", F.lit("merged").alias("kind"), F.col("sid").cast("string").alias("member"))
    members_wifi = (least.join(named.select(F.col("sid").alias("least"), "set_id"), "least")
                    .select("set_id", F.lit("wifi").alias("kind"), F.col("wifi").cast("string").alias("member")).distinct())
    return members_uid.unionByName(members_wifi).unionByName(merged)


def component_members(components: DataFrame, names: DataFrame | None = None, id_col: str = "id",
                      name_col: str = "name") -> DataFrame:
    """GRF-06 / AGG-14 / AGG-27: ``(component, size, member)``, one row per
    member, so a giant component stays spread over many tasks."""
    c = components
    if names is not None:
        c = c.join(names.select(F.col(id_col).alias("id"), F.col(name_col).cast("string").alias("member")), "id", "left")
    else:
        c = c.withColumn("member", F.col("id").cast("string"))
    c = cut_lineage(c.select("component", "member"))
    sizes = c.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return join_counted(c, sizes, "component", "size", c.count()).select("component", "size", "member")


# ------------------------------------------------------ neighbourhoods ---

def triplets(vertices: DataFrame, edges: DataFrame, attr: str = "attr") -> DataFrame:
    """JOI-10: ``(src, dst, src_attr, dst_attr)``."""
    v = vertices.select("id", F.col(attr).alias("a"))
    return (edges.join(v.select(F.col("id").alias("src"), F.col("a").alias("src_attr")), "src")
                 .join(v.select(F.col("id").alias("dst"), F.col("a").alias("dst_attr")), "dst")
                 .select("src", "dst", "src_attr", "dst_attr"))


def neighbor_mean(vertices: DataFrame, edges: DataFrame, attr: str = "attr") -> DataFrame:
    """GRF-07 / AGG-15: for each vertex, count, sum and mean of the attribute
    of in-neighbours whose attribute is greater.  Vertices that get no such
    message are absent."""
    t = triplets(vertices, edges, attr).where(F.col("src_attr") > F.col("dst_attr"))
    return (t.groupBy(F.col("dst").alias("id"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("src_attr").alias("total"), F.avg("src_attr").alias("mean")))


def influence(vertices: DataFrame, edges: DataFrame, name: str = "name", default_name: str = "") -> DataFrame:
    """GRF-08: ``(id, name, influence)``.

    Edges go followee -> follower.  Influence = number of distinct names among
    followers and followers of followers, not counting the vertex's own name
    and the blank name; a vertex without followers scores -1 (the two-round
    message closed form, Q16).  The second hop joins distinct (vertex, name)
    pairs, not pairs of vertices; the edges are built once.
    """
    hop1 = cut_lineage(edges.select(F.col("src").alias("u"), F.col("dst").alias("w")).distinct())
    v = cut_lineage(graph(vertices.select("id", F.col(name).alias("attr")),
                          hop1.select(F.col("u").alias("src"), F.col("w").alias("dst")), default_name))
    called = v.select(F.col("id").alias("w"), F.col("attr").alias("nm"))
    # names instead of vertices from here on: a vertex's followers shrink to their distinct names
    near = cut_lineage(hop1.join(called, "w").select("u", "nm").distinct())
    far = hop1.join(near.select(F.col("u").alias("w"), "nm"), "w").select("u", "nm")
    own = v.join(hop1.select(F.col("u").alias("id")).distinct(), "id")
    names = (near.unionByName(far).unionByName(own.select(F.col("id").alias("u"), F.col("attr").alias("nm")))
                 .unionByName(own.select(F.col("id").alias("u"), F.lit("").alias("nm"))))
    counts = names.distinct().groupBy("u").agg((F.count(F.lit(1)) - 2).alias("influence"))
    return (v.join(counts.select(F.col("u").alias("id"), "influence"), "id", "left")
             .select("id", F.col("attr").alias(name), F.coalesce("influence", F.lit(-1)).cast("bigint")
                     .alias("influence")))


def top_influencer(scores: DataFrame, n: int = 1) -> DataFrame:
    """AGG-16 / SRT-04: the highest influence, ties to the lowest id (top-k)."""
    return scores.orderBy(F.desc("influence"), F.asc("id")).limit(n)


# -------------------------------------------------------- WiFi jobs ---

WIFI_OUTPUT = ["uid", "wifi_name", "geohash", "ip", "bssid", "day_num", "wifi_id", "date_p"]


def recognize_wifi(actions: DataFrame, date_p: str, max_iter: int = 6) -> DataFrame:
    """GRF-09: WiFi recognition.

    ``actions(uid, wifi_name, geohash, ip, day_num, bssid, vid)``.  Rows with
    a bssid use it as ``wifi_id``.  The others form nodes = (wifi_name, ip)
    named by their smallest row id; nodes used by the same (uid, wifi_name)
    are linked, and ``max_iter`` rounds of min-label propagation name the
    clusters.  Rows whose wifi name or ip is NULL never join and keep their
    own row id (Q2).  Both branches are cast to text before the union (Q1).
    """
    graph_rows = actions.where(F.col("bssid").isNull())
    key = ["wifi_name", "ip"]
    has_key = F.col("wifi_name").isNotNull() & F.col("ip").isNotNull()
    keyed = graph_rows.where(has_key)
    # with the rows of each node, so that a node with many is looked up by broadcast
    nodes = cut_lineage(keyed.groupBy(*key).agg(F.min("vid").alias("node"), F.count(F.lit(1)).alias("rows")))
    total = nodes.agg(F.sum("rows")).first()[0] or 0
    membership = (join_counted(keyed.select("uid", *key), nodes, key, "rows", total)
                  .select("node", F.struct("uid", "wifi_name").alias("grp")))
    labels = bounded_group_components(nodes, membership, max_iter)
    clustered = cut_lineage(nodes.join(labels, "node").select(*key, "component", "rows"))
    out_graph = (join_counted(keyed, clustered, key, "rows", total)
                 .unionByName(graph_rows.where(~has_key), allowMissingColumns=True)
                 .select("uid", "wifi_name", "geohash", "ip", "bssid", "day_num",
                         F.coalesce("component", "vid").cast("string").alias("wifi_id"),
                         F.lit(str(date_p)).alias("date_p")))
    out_bssid = (actions.where(F.col("bssid").isNotNull())
                 .select("uid", "wifi_name", "geohash", "ip", "bssid", "day_num",
                         F.col("bssid").cast("string").alias("wifi_id"), F.lit(str(date_p)).alias("date_p")))
    return out_bssid.unionByName(out_graph).select(*WIFI_OUTPUT)


def map_wifi_ids(actions: DataFrame, hash_id: str = "legacy", ordered: bool = False) -> DataFrame:
    """GRF-10: id mapping with name-based node ids.

    Node id = 64-bit name hash of wifi+ip (``legacy``: no separator, two
    pairs can collide, Q5; ``sep``: joined with a tab).  Nodes used by the
    same (uid, wifi_name) are connected; unbounded components; every action
    gets its component id.  Returns ``(vertex_id, uid, wifi_name, ip,
    geohash, day_num)``; ``ordered``: sorted by the first four (a range exchange).
    """
    key = (F.concat(F.col("wifi_name"), F.col("ip")) if hash_id == "legacy"
           else F.concat_ws("\t", F.col("wifi_name"), F.col("ip")))
    actions = cut_lineage(actions)  # read by every branch below
    nodes = cut_lineage(actions.select("wifi_name", "ip").distinct().withColumn("node", name_id(key)))
    mem = nodes.join(actions.select("uid", "wifi_name", "ip"), ["wifi_name", "ip"], "left")
    star = cooccurrence_edges(mem, ["uid", "wifi_name"], "node")
    comp = connected_components(nodes.select(F.col("node").alias("id")), star, id_col="id")
    clustered = nodes.join(comp.select(F.col("id").alias("node"), "component"), "node")
    out = (actions.join(clustered.select("wifi_name", "ip", "component"), ["wifi_name", "ip"], "left")
                  .select(F.col("component").alias("vertex_id"), "uid", "wifi_name", "ip", "geohash", "day_num"))
    return out.orderBy("vertex_id", "uid", "wifi_name", "ip") if ordered else out
