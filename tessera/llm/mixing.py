"""Mixing sources to target weights.

Temperature mixing: source i with token share p_i gets a weight proportional to
p_i ** a.  The exponent a in [0, 1] is found by bisection so that the weights
meet a target entropy, or so that no source is repeated more than a limit.

The weights are realised within a token budget by block permutations: a keyed
hash puts the documents of a source in a fixed random order, cut into blocks
of consecutive documents; whole passes take every document, and the last,
partial pass takes documents in that order up to the source's remaining
budget.  Where that pass ends is found block by block: token sums of 4096
blocks, then of 4096 parts of the block where it ends, and so on down to one
document -- so no task or window ever sees more than 4096 rows of a source,
however large the source is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import join_counted, small
from ..session import cut_lineage

ORDER_BITS, LEVEL_BITS = 60, 12
STEPS, HALVINGS = 40, 4  # halvings of [0, 1] in all, and per pass over the sources


@dataclass(frozen=True)
class Target:
    """Exactly one of the two.  ``entropy``: of the weights, in nats.
    ``repetition``: how often the most repeated source is passed over, at most."""
    entropy: float | None = None
    repetition: float | None = None

    def __post_init__(self):
        if (self.entropy is None) == (self.repetition is None):
            raise ValueError("give an entropy or a repetition limit")


def words(text: Column) -> Column:
    """Words of a text, at least 1: an empty document counts as one token."""
    return F.greatest(F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1))


def _units(docs: DataFrame, id_col: str, source_col: str, tokens: Column, seed: int) -> DataFrame:
    """``(doc_id, source, key, u, tokens)``: one row per id and source, rows that
    repeat both being one document; ``u``: its place in the source's order."""
    doc_id, source = F.col(id_col).cast("bigint"), F.col(source_col).cast("string")
    rows = docs.select(doc_id.alias("doc_id"), source.alias("source"), tokens.cast("bigint").alias("tokens"))
    return (rows.groupBy("doc_id", "source").agg(F.sum("tokens").alias("tokens"))
            .withColumn("key", F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), "source")))
            .withColumn("u", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << ORDER_BITS))))


def _entropies(sources: DataFrame, exponents: list[float], total: int) -> list[float]:
    """Entropy of the weights for each exponent, in one pass.  With x = share ** a
    and z = sum x, H = log z - (sum x log x) / z."""
    x = [F.exp(F.log(F.col("tokens") / F.lit(float(total))) * a) for a in exponents]
    r = sources.agg(*[f for v in x for f in (F.sum(v), F.sum(v * F.log(v)))]).first()
    return [math.log(r[2 * i]) - r[2 * i + 1] / r[2 * i] for i in range(len(x))]


def _repetitions(sources: DataFrame, exponents: list[float], total: int, budget: float | None) -> list[float]:
    """Passes over the most repeated source for each exponent, in one pass.
    Without a budget the least repeated source is passed over once."""
    share = F.col("tokens") / F.lit(float(total))
    x = [F.exp(F.log(share) * a) for a in exponents]
    r = sources.agg(*[f for v in x for f in (F.sum(v), F.max(v / share), F.min(v / share))]).first()
    each = [r[3 * i:3 * i + 3] for i in range(len(x))]
    return [most / least if budget is None else budget / total * most / z for z, most, least in each]


def find_exponent(sources: DataFrame, target: Target, budget: float | None = None) -> float:
    """Bisect the exponent over ``sources`` (one row per source, ``tokens`` > 0).
    Entropy falls and repetition falls as the exponent grows; a target that no
    exponent reaches gives the nearer end of [0, 1].  A pass over the sources
    measures the 15 points that four halvings could ask for."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return 1.0

    def too_flat(exponents: list[float]) -> list[bool]:
        if target.entropy is not None:
            return [h > target.entropy for h in _entropies(sources, exponents, total)]
        return [n > target.repetition for n in _repetitions(sources, exponents, total, budget)]

    if not too_flat([0.0])[0]:
        return 0.0
    low, high, points = 0.0, 1.0, 1 << HALVINGS
    for _ in range(STEPS // HALVINGS):
        grid = [low + (high - low) * i / points for i in range(points + 1)]
        flat = too_flat(grid[1:-1])
        i = flat.index(False) if False in flat else points - 1  # grid[i] is too flat, grid[i + 1] is not
        low, high = grid[i], grid[i + 1]
    return high


def mix(docs: DataFrame, target: Target, budget: float | None = None, id_col: str = "doc_id",
        source_col: str = "source", tokens: Column | None = None, seed: int = 42) -> DataFrame:
    """One row per document: ``(doc_id, source, tokens, weight, copies)``.

    ``weight``: the source's share of the mix; ``copies``: how often the
    document is in it.  ``budget``: tokens of the mix; None: the smallest budget
    that uses every document at least once.  A source's tokens never exceed its
    share of the budget and miss it by less than the document that did not fit.
    A NULL source is a source of its own; a NULL id is one document per source;
    rows that repeat id and source are one document of their summed tokens; an
    empty document counts as one token.  An empty input gives no rows."""
    units = cut_lineage(_units(docs, id_col, source_col, words(F.col("text")) if tokens is None else tokens, seed))
    sources = cut_lineage(units.groupBy("key").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")))
    a = find_exponent(sources, target, budget)
    whole = sources.agg(F.sum("tokens").alias("t"), F.sum("n").alias("n")).first()
    share = F.col("tokens") / F.lit(float(whole["t"] or 1))
    weighed = sources.withColumn("x", F.exp(F.log(share) * a))
    r = weighed.agg(F.sum("x").alias("z"), F.min(F.col("x") / F.col("tokens")).alias("least")).first()
    # budget * weight = tokens for the least repeated source if none is given
    scale = 1.0 if r["z"] is None else (1 / r["least"] if budget is None else budget / r["z"])
    # a hair of slack, so that the least repeated source is not one token short by rounding
    goal = F.floor(F.col("x") * scale * (1 + 1e-12) + 1e-9)
    plan = weighed.select("key", "n", (F.col("x") / F.lit(r["z"] or 1.0)).alias("weight"),
                          F.floor(goal / F.col("tokens")).cast("int").alias("passes"),
                          (goal % F.col("tokens")).alias("left"))
    plan = cut_lineage(plan)
    ends = _where_passes_end(units, plan.where(F.col("left") > 0).select("key", "n", "left"), whole["n"] or 0)
    plan = cut_lineage(plan.join(ends, "key", "left").select("key", "n", "weight", "passes", F.coalesce("cut", F.lit(0)).alias("cut")))
    out = join_counted(units, plan, "key", "n", whole["n"] or 0)
    copies = F.col("passes") + (F.col("u") < F.col("cut")).cast("int")
    return out.select("doc_id", "source", "tokens", "weight", copies.alias("copies"))


def _where_passes_end(units: DataFrame, plan: DataFrame, total: int) -> DataFrame:
    """``(key, cut)``: the documents with ``u < cut``, in the order of ``u``, are
    those that ``left`` tokens allow."""
    at = plan.withColumn("lo", F.lit(0).cast("bigint"))
    for level in range(1, ORDER_BITS // LEVEL_BITS + 1):
        size = 1 << (ORDER_BITS - LEVEL_BITS * level)  # of a block at this level, in places
        whole = size << LEVEL_BITS
        near = join_counted(units.select("key", "u", "tokens"), at, "key", "n", total)
        inside = near.where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("lo") + F.lit(whole)))
        blocks = inside.groupBy("key", "n", "left", (F.col("u") - F.col("u") % F.lit(size)).alias("block")).agg(
            F.sum("tokens").alias("sum"), F.count(F.lit(1)).alias("docs"))
        # at most 4096 blocks a source
        upto = F.sum("sum").over(Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        over = (blocks.withColumn("upto", upto).where(F.col("upto") > F.col("left"))
                .groupBy("key", "n").agg(F.min(F.struct("block", (F.col("left") - F.col("upto") + F.col("sum")).alias("left"),
                                                        "docs")).alias("b")))
        at = cut_lineage(over.select("key", "n", F.col("b.left").alias("left"), F.col("b.block").alias("lo"), F.col("b.docs").alias("docs")))
        if level < ORDER_BITS // LEVEL_BITS:
            if (at.agg(F.max("docs")).first()[0] or 0) <= 1:
                # one document is left in every block: it is the first that does not fit
                last = join_counted(units.select("key", "u"), at, "key", "n", total)
                return (last.where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("lo") + F.lit(size)))
                        .select("key", F.col("u").alias("cut")))
            at = at.select("key", "n", "left", "lo")
    return at.select("key", F.col("lo").alias("cut"))


def realise(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with every document repeated ``copies`` times, columns unchanged."""
    m = mixed.where(F.col("copies") > 0).select(
        F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("copies").alias("_mix_copies"))
    here = F.col(f"d.`{source_col}`").cast("string").eqNullSafe(F.col("_mix_source"))
    has_id = F.col(f"`{id_col}`").isNotNull()
    named = docs.where(has_id).alias("d").join(m.where(F.col("_mix_id").isNotNull()),
                                               (F.col(f"d.`{id_col}`").cast("bigint") == F.col("_mix_id")) & here)
    # rows without an id are one document per source: a row a source goes to them, not they to it
    of_source = cut_lineage(m.where(F.col("_mix_id").isNull()))
    nameless = docs.where(~has_id).alias("d").join(small(of_source, of_source.count(), 256), here)
    return named.union(nameless).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
