"""Graph queries bound to the driver tables.

* ``components`` / ``components_bounded`` / ``id_sets``: the bipartite graph
  order -- part of every line item (all of ``lineitem``), vertices = all
  orders and all parts (part ids offset so the two id ranges cannot clash).
* ``cooccurrence_edges``: parts bought by the same customer within a brand.
* ``neighbor_mean`` / ``influence`` / ``influence_top``: customers, with an
  edge from the customer of order k to the customer of order k+1.
* ``wifi_recognize`` / ``wifi_id_mapping``: every event is a WiFi action:
  uid = user_id, wifi name = event_type, ip = ``dd-HH`` of ts, row id =
  event_id, bssid = ``props.k`` as text when even.

The oracle SQL computes components with DuckDB recursive CTEs (frontier
min-label propagation with ``USING KEY``), independently of the Spark
large-star / small-star plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import name_id
from ..operators import graph as G
from ..session import cut_lineage
from ..sources.tables import Tables
from .common import r6, register

PART_OFFSET = 1_000_000_000_000
BOUNDED_ROUNDS = 3
WIFI_ROUNDS = 6
DATE_P = "20240101"


def bipartite(t: Tables) -> tuple[DataFrame, DataFrame]:
    li = t.lineitem
    edges = li.select(F.col("l_orderkey").alias("src"), (F.col("l_partkey") + F.lit(PART_OFFSET)).alias("dst"))
    vertices = (t.orders.select(F.col("o_orderkey").alias("id"))
                .unionByName(t.part.select((F.col("p_partkey") + F.lit(PART_OFFSET)).alias("id"))))
    return vertices, edges


_BIPARTITE_SQL = f"""
e AS (SELECT DISTINCT l_orderkey AS a, l_partkey + {PART_OFFSET} AS b FROM lineitem
      WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL),
s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
v AS (SELECT o_orderkey AS id FROM orders UNION SELECT p_partkey + {PART_OFFSET} FROM part UNION SELECT a FROM s)"""

_CC_SQL = """
cc(node, lab) USING KEY (node) AS (
  SELECT id, id FROM v
  UNION
  (SELECT s.b, min(cc.lab) FROM cc JOIN s ON s.a = cc.node JOIN recurring.cc r ON r.node = s.b
   GROUP BY s.b HAVING min(cc.lab) < min(r.lab)))"""


@register("components", f"""
WITH RECURSIVE {_BIPARTITE_SQL},{_CC_SQL}
SELECT node AS id, lab AS component FROM cc
""")
def components(t: Tables) -> DataFrame:
    """GRF-02: connected components (smallest id) of the order-part graph."""
    v, e = bipartite(t)
    return G.connected_components(v, e)


@register("components_bounded", f"""
WITH RECURSIVE {_BIPARTITE_SQL},
s2 AS (SELECT a, b FROM s UNION ALL SELECT id, id FROM v),
lab(i, node, l) AS (
  SELECT 0, id, id FROM v
  UNION ALL
  SELECT lab.i + 1, s2.b, min(lab.l) FROM lab JOIN s2 ON s2.a = lab.node
  WHERE lab.i < {BOUNDED_ROUNDS} GROUP BY lab.i, s2.b)
SELECT node AS id, l AS component FROM lab WHERE i = {BOUNDED_ROUNDS}
""")
def components_bounded(t: Tables) -> DataFrame:
    """GRF-03: exactly 3 rounds of min-label propagation."""
    v, e = bipartite(t)
    return G.bounded_components(v, e, BOUNDED_ROUNDS)


@register("id_sets", """
WITH RECURSIVE p AS (SELECT DISTINCT l_orderkey AS uid, l_partkey AS wifi FROM lineitem WHERE l_orderkey IS NOT NULL),
u AS (SELECT uid, row_number() OVER (ORDER BY uid) AS sid FROM (SELECT DISTINCT uid FROM p)),
ps AS (SELECT p.uid, p.wifi, u.sid FROM p JOIN u USING (uid)),
st AS (SELECT wifi, min(sid) AS m FROM ps WHERE wifi IS NOT NULL GROUP BY wifi),
e AS (SELECT DISTINCT ps.sid AS a, st.m AS b FROM ps JOIN st USING (wifi) WHERE ps.sid <> st.m),
s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
v AS (SELECT sid AS id FROM u),
cc(node, lab) USING KEY (node) AS (
  SELECT id, id FROM v
  UNION
  (SELECT s.b, min(cc.lab) FROM cc JOIN s ON s.a = cc.node JOIN recurring.cc r ON r.node = s.b
   GROUP BY s.b HAVING min(cc.lab) < min(r.lab))),
x AS (SELECT ps.*, cc.lab AS set_id FROM ps JOIN cc ON cc.node = ps.sid)
SELECT DISTINCT set_id, 'uid' AS kind, CAST(uid AS VARCHAR) AS member FROM x
UNION SELECT DISTINCT set_id, 'wifi', CAST(wifi AS VARCHAR) FROM x WHERE wifi IS NOT NULL
UNION SELECT DISTINCT set_id, 'merged', CAST(sid AS VARCHAR) FROM x
""")
def id_sets(t: Tables) -> DataFrame:
    """GRF-05: identity sets over (uid = order, wifi = part), long form."""
    pairs = t.lineitem.select(F.col("l_orderkey").alias("uid"), F.col("l_partkey").alias("wifi"))
    return G.reduce_id_sets(pairs)


@register("cooccurrence_edges", """
WITH ids AS (SELECT DISTINCT o_custkey, p_brand, l_partkey AS dst
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
             WHERE l_partkey IS NOT NULL),
m AS (SELECT o_custkey, p_brand, min(dst) AS src FROM ids GROUP BY o_custkey, p_brand)
SELECT ids.o_custkey, ids.p_brand, m.src, ids.dst
FROM ids JOIN m ON ids.o_custkey = m.o_custkey AND ids.p_brand = m.p_brand
WHERE ids.dst <> m.src
""")
def cooccurrence_edges(t: Tables) -> DataFrame:
    """GRF-04: parts co-bought by a customer within a brand (spanning star)."""
    df = (t.lineitem.select("l_orderkey", "l_partkey")
          .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
          .join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")))
    return G.cooccurrence_edges(df, ["o_custkey", "p_brand"], "l_partkey")


def customer_graph(t: Tables) -> tuple[DataFrame, DataFrame]:
    o = t.orders.select("o_orderkey", "o_custkey")
    nxt = o.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("dst"))
    edges = o.join(nxt, "o_orderkey").select(F.col("o_custkey").alias("src"), "dst")
    vertices = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                 F.col("c_acctbal").alias("attr"))
    return vertices, edges


_CUST_EDGES_SQL = """
e AS (SELECT o1.o_custkey AS src, o2.o_custkey AS dst FROM orders o1 JOIN orders o2 ON o2.o_orderkey = o1.o_orderkey + 1)"""


@register("neighbor_mean", f"""
WITH {_CUST_EDGES_SQL}
SELECT e.dst AS id, count(*) AS n, round(sum(a.c_acctbal), 6) AS total, round(avg(a.c_acctbal), 6) AS mean
FROM e JOIN customer a ON a.c_custkey = e.src JOIN customer b ON b.c_custkey = e.dst
WHERE a.c_acctbal > b.c_acctbal
GROUP BY e.dst
""")
def neighbor_mean(t: Tables) -> DataFrame:
    """GRF-07: mean balance of richer in-neighbours."""
    v, e = customer_graph(t)
    r = G.neighbor_mean(v, e, "attr")
    return r.select("id", "n", r6("total").alias("total"), r6("mean").alias("mean"))


_INFLUENCE_SQL = f"""
WITH {_CUST_EDGES_SQL},
ends AS (SELECT src AS id FROM e UNION SELECT dst FROM e),
v AS (SELECT c_custkey AS id, coalesce(c_name, '') AS nm FROM customer
      UNION ALL SELECT id, '' FROM ends WHERE id NOT IN (SELECT c_custkey FROM customer)),
h1 AS (SELECT DISTINCT src AS u, dst AS w FROM e),
h2 AS (SELECT DISTINCT a.u, b.w FROM h1 a JOIN h1 b ON a.w = b.u),
r AS (SELECT u, w FROM h1 UNION SELECT u, w FROM h2),
nm AS (SELECT r.u, v.nm FROM r JOIN v ON v.id = r.w
       UNION ALL SELECT v.id, v.nm FROM v WHERE v.id IN (SELECT u FROM h1)
       UNION ALL SELECT u, '' FROM h1),
c AS (SELECT u, count(DISTINCT nm) - 2 AS influence FROM nm GROUP BY u),
scores AS (SELECT v.id, v.nm AS name, CAST(coalesce(c.influence, -1) AS BIGINT) AS influence
           FROM v LEFT JOIN c ON c.u = v.id)"""


@register("influence", _INFLUENCE_SQL + "\nSELECT * FROM scores")
def influence(t: Tables) -> DataFrame:
    """GRF-08: names within two follower hops, for every customer."""
    v, e = customer_graph(t)
    return G.influence(v, e, "name")


@register("influence_top", _INFLUENCE_SQL + "\nSELECT * FROM scores ORDER BY influence DESC, id LIMIT 1")
def influence_top(t: Tables) -> DataFrame:
    """GRF-08 + SRT-04: the most influential customer (ties: lowest id)."""
    v, e = customer_graph(t)
    return G.top_influencer(G.influence(v, e, "name"), 1)


def wifi_actions(t: Tables) -> DataFrame:
    ev = t.events
    k = F.regexp_extract("props", '"k":\\s*(-?[0-9]+)', 1).try_cast("int")
    return ev.select(F.col("user_id").alias("uid"), F.col("event_type").alias("wifi_name"),
                     F.lit(None).cast("string").alias("geohash"), F.date_format("ts", "dd-HH").alias("ip"),
                     F.dayofmonth("ts").alias("day_num"),
                     F.when(k % 2 == 0, k.cast("string")).alias("bssid"),
                     F.col("event_id").alias("vid"))


_WIFI_ACTIONS_SQL = """
a AS (SELECT user_id AS uid, event_type AS wifi_name, CAST(NULL AS VARCHAR) AS geohash, strftime(ts, '%d-%H') AS ip,
             CAST(dayofmonth(ts) AS INTEGER) AS day_num,
             CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) END AS bssid, event_id AS vid
      FROM (SELECT *, TRY_CAST(regexp_extract(props, '"k":\\s*(-?[0-9]+)', 1) AS INTEGER) AS k FROM events))"""


@register("wifi_recognize", f"""
WITH RECURSIVE {_WIFI_ACTIONS_SQL},
g AS (SELECT * FROM a WHERE bssid IS NULL),
nodes AS (SELECT wifi_name, ip, min(vid) AS node FROM g GROUP BY wifi_name, ip),
mem AS (SELECT DISTINCT n.node, CAST(g.uid AS VARCHAR) || '|' || g.wifi_name AS grp
        FROM nodes n JOIN g ON n.wifi_name = g.wifi_name AND n.ip = g.ip
        UNION SELECT node, 'self|' || CAST(node AS VARCHAR) FROM nodes),
lab(i, node, l) AS (
  SELECT 0, node, node FROM nodes
  UNION ALL
  SELECT gm.i + 1, m2.node, min(gm.gl)
  FROM (SELECT lab.i, m1.grp, min(lab.l) AS gl FROM lab JOIN mem m1 ON m1.node = lab.node
        WHERE lab.i < {WIFI_ROUNDS} GROUP BY lab.i, m1.grp) gm
  JOIN mem m2 ON m2.grp = gm.grp GROUP BY gm.i, m2.node),
cl AS (SELECT n.wifi_name, n.ip, lab.l FROM nodes n JOIN lab ON lab.node = n.node AND lab.i = {WIFI_ROUNDS})
SELECT uid, wifi_name, geohash, ip, bssid, day_num, bssid AS wifi_id, '{DATE_P}' AS date_p FROM a WHERE bssid IS NOT NULL
UNION ALL
SELECT g.uid, g.wifi_name, g.geohash, g.ip, g.bssid, g.day_num, CAST(coalesce(cl.l, g.vid) AS VARCHAR), '{DATE_P}'
FROM g LEFT JOIN cl ON g.wifi_name = cl.wifi_name AND g.ip = cl.ip
""")
def wifi_recognize(t: Tables) -> DataFrame:
    """GRF-09: WiFi recognition with 6 bounded rounds."""
    return G.recognize_wifi(wifi_actions(t), DATE_P, WIFI_ROUNDS)


@register("wifi_id_mapping", f"""
WITH RECURSIVE {_WIFI_ACTIONS_SQL},
n0 AS (SELECT DISTINCT wifi_name, ip FROM a),
nodes AS (SELECT wifi_name, ip,
  CAST(CASE WHEN u >= 9223372036854775808 THEN u - 18446744073709551616 ELSE u END AS BIGINT) AS node
  FROM (SELECT wifi_name, ip, CAST(CAST(('0x' || substr(h, 1, 12) || '3' || substr(h, 14, 3)) AS UBIGINT) AS HUGEINT) AS u
        FROM (SELECT wifi_name, ip, md5(wifi_name || ip) AS h FROM n0))),
mem AS (SELECT n.node, g.uid, g.wifi_name FROM nodes n JOIN a g ON n.wifi_name = g.wifi_name AND n.ip = g.ip),
m AS (SELECT uid, wifi_name, min(node) AS mn FROM mem WHERE node IS NOT NULL GROUP BY uid, wifi_name),
e AS (SELECT DISTINCT mem.node AS a, m.mn AS b FROM mem JOIN m ON mem.uid = m.uid AND mem.wifi_name = m.wifi_name
      WHERE mem.node <> m.mn),
s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
v AS (SELECT node AS id FROM nodes WHERE node IS NOT NULL),
{_CC_SQL.strip()}
SELECT cc.lab AS vertex_id, a.uid, a.wifi_name, a.ip, a.geohash, a.day_num
FROM a LEFT JOIN nodes n ON a.wifi_name = n.wifi_name AND a.ip = n.ip LEFT JOIN cc ON cc.node = n.node
""")
def wifi_id_mapping(t: Tables) -> DataFrame:
    """GRF-10: id mapping with name-hash node ids and unbounded components."""
    return G.map_wifi_ids(wifi_actions(t).drop("bssid", "vid"), ordered=True)


@register("component_members", f"""
WITH RECURSIVE {_WIFI_ACTIONS_SQL},
n0 AS (SELECT DISTINCT wifi_name, ip FROM a),
nodes AS (SELECT wifi_name, ip,
  CAST(CASE WHEN u >= 9223372036854775808 THEN u - 18446744073709551616 ELSE u END AS BIGINT) AS node
  FROM (SELECT wifi_name, ip, CAST(CAST(('0x' || substr(h, 1, 12) || '3' || substr(h, 14, 3)) AS UBIGINT) AS HUGEINT) AS u
        FROM (SELECT wifi_name, ip, md5(wifi_name || ip) AS h FROM n0))),
mem AS (SELECT n.node, g.uid, g.wifi_name FROM nodes n JOIN a g ON n.wifi_name = g.wifi_name AND n.ip = g.ip),
m AS (SELECT uid, wifi_name, min(node) AS mn FROM mem WHERE node IS NOT NULL GROUP BY uid, wifi_name),
e AS (SELECT DISTINCT mem.node AS a, m.mn AS b FROM mem JOIN m ON mem.uid = m.uid AND mem.wifi_name = m.wifi_name
      WHERE mem.node <> m.mn),
s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
v AS (SELECT node AS id FROM nodes WHERE node IS NOT NULL),
{_CC_SQL.strip()}
SELECT cc.lab AS component, count(*) OVER (PARTITION BY cc.lab) AS size, n.wifi_name || '@' || n.ip AS member
FROM cc JOIN nodes n ON n.node = cc.node
""")
def component_members(t: Tables) -> DataFrame:
    """GRF-06 / AGG-14 / AGG-27: the members of every WiFi cluster, one row each."""
    acts = cut_lineage(wifi_actions(t).select("uid", "wifi_name", "ip"))
    key = F.concat(F.col("wifi_name"), F.col("ip"))
    # a stored table: both join sides are plain shuffles, which Spark splits at a hot key
    nodes = cut_lineage(acts.select("wifi_name", "ip").distinct().withColumn("node", name_id(key)))
    mem = nodes.join(acts, ["wifi_name", "ip"], "left")
    star = G.cooccurrence_edges(mem, ["uid", "wifi_name"], "node")
    comp = G.connected_components(nodes.select(F.col("node").alias("id")), star, id_col="id")
    names = nodes.select(F.col("node").alias("id"), F.concat_ws("@", "wifi_name", "ip").alias("name"))
    return G.component_members(comp, names)
