"""Embedding near-dedup: an exact metric range join.

Angles between vectors are a metric, so with a = arccos(threshold) a link is a
pair within angle a.  Pivots (a bounded sample of the vectors) cut each label's
vectors into cells by nearest pivot.  A vector v can only be linked to a vector
whose home is cell i if, by the triangle inequality,

    angle(v, p_i) <= angle(v, p_home) + 2 a,

and, more sharply, if the cell's boundary itself is within reach: on unit
vectors the boundary of cells i and home is the plane with normal
p_i - p_home, so (v.p_home - v.p_i) / |p_home - p_i| <= sin a.  v is replicated
to the cells that pass both tests; each cell then joins on its own and finds
every link of the vectors at home there.

Equal vectors are joined once, by one representative with its number of
copies.  A cell is compared in blocks of bounded size (matrix products in
double precision); a block writes link counts and, for its linked vectors, one
edge each to the smallest id they are connected to in the block, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import component_edges
from ..operators.skew import join_counted
from ..session import cut_lineage

BLOCK = 1024
MAX_PIVOTS = 4096  # bounds the sample and its broadcast, with the vectors' size
_SLACK = 1e-9  # rounding of the replication tests; too wide only costs replicas


def _matrix(column: pa.Array) -> np.ndarray:
    """Equal-length vectors as rows, each scaled by a power of two (exactly) so
    that squares neither overflow nor vanish."""
    x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _homes(reps: DataFrame, pivots: dict[int, np.ndarray], angle: float) -> DataFrame:
    """``reps`` with ``cell`` and ``home``: a row for each cell a vector is
    needed in.  A dimension without pivots is one cell."""
    sent = reps.sparkSession.sparkContext.broadcast(pivots)
    names = reps.columns

    def place(batches):
        for b in batches:
            dims = np.asarray(b.column(names.index("dim")))
            for d in np.unique(dims):
                part = b.filter(pa.array(dims == d))
                p = sent.value.get(int(d))
                if p is None:
                    row, cell, home = np.arange(part.num_rows), np.zeros(part.num_rows, np.int64), np.ones(part.num_rows, bool)
                else:
                    for at in range(0, part.num_rows, 2000):  # bounds the distances held at once
                        yield _placed(part.slice(at, 2000), names, p, angle)
                    continue
                yield _with(part, names, row, cell, home)

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in reps.schema.fields)
    return reps.mapInArrow(place, f"{types}, cell int, home boolean")


def _placed(part: pa.RecordBatch, names: list[str], p: np.ndarray, angle: float) -> pa.RecordBatch:
    cos = np.clip(_unit(_matrix(part.column(names.index("emb")))) @ p.T, -1, 1)
    home = cos.argmax(1)
    best = cos[np.arange(len(cos)), home]
    apart = np.sqrt(np.maximum(2 - 2 * np.clip(p @ p.T, -1, 1), 0))
    near = (best[:, None] - cos) <= math.sin(angle) * apart[home] + _SLACK
    near &= np.arccos(cos) <= np.arccos(best)[:, None] + 2 * angle + _SLACK
    near[np.arange(len(cos)), home] = True
    row, cell = np.nonzero(near)
    return _with(part, names, row, cell, cell == home[row])


def _with(part: pa.RecordBatch, names: list[str], row, cell, home) -> pa.RecordBatch:
    out = part.take(pa.array(row))
    return pa.RecordBatch.from_arrays([*out.columns, pa.array(cell.astype(np.int32)), pa.array(home)],
                                      names=[*names, "cell", "home"])


def _pivots(reps: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Unit pivots by dimension: the ``sqrt(n) / 4`` vectors (16 to
    ``MAX_PIVOTS``) with the smallest hash of their id.  Any choice is exact."""
    k = min(MAX_PIVOTS, max(16, int(math.sqrt(n)) // 4))
    rows = reps.orderBy(F.xxhash64("rep"), "rep").limit(k).select("dim", "emb").collect()
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["dim"], []).append(r["emb"])
    return {d: _unit(_matrix(pa.array(v, pa.list_(pa.float64())))) for d, v in out.items()}


def _compare(threshold: float):
    def compare(table: pa.Table) -> pa.Table:
        asks = np.asarray(table.column("asks"))
        t = [table.filter(pa.array(x)) for x in (asks, ~asks)]
        if not t[0].num_rows or not t[1].num_rows:
            return pa.table({"src": pa.array([], pa.int64()), "dst": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        x, y = (_matrix(s.column("emb").combine_chunks()) for s in t)
        a, b = (np.asarray(s.column("rep")) for s in t)
        size = np.asarray(t[1].column("n"))
        nx, ny = (np.sqrt((m * m).sum(1)) for m in (x, y))
        cos = (x @ y.T) / (nx[:, None] * ny[None, :])
        hit = cos >= threshold
        for i, j in zip(*np.nonzero(np.abs(cos - threshold) < 1e-13)):  # too close to leave to the order of a sum
            hit[i, j] = math.fsum(x[i] * y[j]) / (nx[i] * ny[j]) >= threshold
        hit &= a[:, None] != b[None, :]
        links = hit @ size
        # smallest id connected to each vector within the block
        la, lb = a.copy(), b.copy()
        top = np.iinfo(np.int64).max
        while True:
            na = np.minimum(la, np.where(hit, lb[None, :], top).min(1))
            nb = np.minimum(lb, np.where(hit, na[:, None], top).min(0))
            if (na == la).all() and (nb == lb).all():
                break
            la, lb = na, nb
        asked, met = links > 0, hit.any(0)
        return pa.table({"src": np.append(a[asked], b[met]), "dst": np.append(la[asked], lb[met]),
                         "links": np.append(links[asked], np.zeros(met.sum(), np.int64)).astype(np.int64)})

    return compare


def _links(reps: DataFrame, threshold: float, block: int) -> DataFrame:
    """``(src, dst, links)``: per block, what ``_compare`` found."""
    angle = math.acos(threshold)
    n = reps.count()
    placed = cut_lineage(_homes(reps, _pivots(reps, n), angle))
    cell = ["label", "dim", "cell"]
    sizes = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("members"), F.sum(F.col("home").cast("int")).alias("homes"))
    sizes = cut_lineage(sizes.where(F.col("homes") > 0).withColumn("rows", F.ceil(F.col("homes") / block).cast("int"))
                        .withColumn("cols", F.ceil(F.col("members") / block).cast("int")))
    known = join_counted(placed, sizes, cell, "members", placed.count())
    own = [*cell, "rep", "n", "emb"]
    asks = known.where("home").withColumn("i", F.pmod(F.xxhash64("rep"), F.col("rows"))).select(
        *own, F.col("i").cast("int").alias("i"), F.explode(F.expr("sequence(0, cols - 1)")).alias("j"), F.lit(True).alias("asks"))
    met = known.withColumn("j", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("cols"))).select(
        *own, F.explode(F.expr("sequence(0, rows - 1)")).alias("i"), F.col("j").cast("int").alias("j"), F.lit(False).alias("asks"))
    return (asks.unionByName(met).groupBy(*cell, "i", "j")
            .applyInArrow(_compare(threshold), "src bigint, dst bigint, links bigint"))


def embedding_dedup(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """One row per vector: ``(vec_id, n_links, component_id, kept)``.

    Vectors of one label and dimension are linked when their cosine is at
    least ``threshold`` (above 0).  A vector that is NULL, empty, zero or holds
    NULL or non-finite components, or whose label or id is NULL, links with
    nothing: 0 links, its own component.  ``component_id``: smallest id reachable
    by links; ``kept``: whether that is the vector's own id.  Rows that repeat an
    id are vectors that share it.  An empty input gives no rows."""
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    finite = F.forall("emb", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).alias("emb"))
    able = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("emb") > 0)
            & finite & F.exists("emb", lambda x: x != 0))
    rows = rows.withColumn("able", F.coalesce(able, F.lit(False)))
    groups = (rows.where("able").groupBy("label", "emb").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    reps = cut_lineage(groups.select("rep", "label", F.size("emb").alias("dim"), "n", "emb"))
    found = cut_lineage(_links(reps, threshold, block))
    parents = component_edges(found.where(F.col("src") != F.col("dst")))
    counts = found.groupBy(F.col("src").alias("rep")).agg(F.sum("links").alias("links"))
    named = (reps.join(counts, "rep", "left").join(parents.select(F.col("x").alias("rep"), F.col("y").alias("root")), "rep", "left")
             .select("label", "emb", "n", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("root", "rep").alias("component_id")))
    named = cut_lineage(named)
    linked = join_counted(rows.where("able").drop("able"), named, ["label", "emb"], "n", rows.where("able").count())
    alone = rows.where(~F.col("able")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (linked.select("vec_id", "n_links", "component_id").unionByName(alone)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
