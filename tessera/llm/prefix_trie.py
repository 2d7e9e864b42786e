"""Trie of conversations by their first turns, by van Emde Boas recursion.

A trie of height 2^k is cut at half its height: the upper trie holds the first
2^(k-1) turns, and under each of its leaves -- a *cut prefix* -- hangs a lower
trie of the same height.  Upper and lower tries are cut again, all at once: the
pieces of one size are rows of one table, so a trie as deep as D takes about
log2 D rounds of joins, not D, and a long conversation is spread like any other.

1. ``_pieces``: the aligned pieces of 1, 2, 4, ... turns of every conversation,
   each named by its two halves.
2. ``_prefixes``: from the root down, a cut prefix and the piece behind it name
   the cut prefixes half way between.  After the last round every prefix has
   its name; equal names meet in one aggregate, the nodes.
3. ``_totals``: upwards, the totals of the lower tries are grafted on the cut
   prefix they hang under, which gives every trie of height 2^k its total; then
   downwards, a node half way gets the total of its own trie and those of the
   whole subtrees below it.

A name is the SHA-256 digest of what it stands for, so equal names are equal
turns.  Members of a node are counted, never gathered; its list of ids is hashed
as a stream, in pieces that are put together where the ids lie.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_counted
from ..sources.sinks import global_row_number
from .common import stored

_ROOT = "00" * 32


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def number_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """``(conv_id, pos, mark, chars)``: the turns of every conversation from 0, by
    ``turn`` (NULL first; equal turns by the digest of their content), with the
    digest of role and text and the text's code points.  A NULL role or text is
    empty; rows without an id belong to no conversation and are left out.  Repeated
    rows are turns of their own.

    The position is the row's place in the order of all rows less that of the
    conversation's first, so a conversation of any length is spread."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    role = text(role_col)
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
        _digest(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text(text_col)), "utf-8")).alias("mark"),
        F.length(text(text_col)).cast("bigint").alias("chars"), F.monotonically_increasing_id().alias("row"))
    placed = stored(global_row_number(rows, ["conv_id", "turn", "mark", "row"], "place"))
    firsts = stored(placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")))
    return stored(join_counted(placed, firsts, "conv_id", "n", placed.count())
                  .select("conv_id", (F.col("place") - F.col("first")).alias("pos"), "mark", "chars"))


def _pieces(turns: DataFrame, height: int) -> list[DataFrame]:
    """Per k < ``height``: ``(conv_id, at, name)`` of the pieces of 2^k turns that
    begin at turn ``at`` 2^k."""
    out = [turns.select("conv_id", F.col("pos").alias("at"), F.col("mark").alias("name"))]
    for _ in range(1, height):
        odd = F.col("at") % 2 == 1
        pairs = out[-1].groupBy("conv_id", F.floor(F.col("at") / 2).alias("at")).agg(
            F.max(F.when(~odd, F.col("name"))).alias("left"), F.max(F.when(odd, F.col("name"))).alias("right"))
        out.append(stored(pairs.where(F.col("right").isNotNull()).select("conv_id", "at", _digest("left", "right").alias("name"))))
    return out


def _prefixes(convs: DataFrame, pieces: list[DataFrame]) -> DataFrame:
    """``(conv_id, depth, name)`` of every prefix of every conversation."""
    known = convs.select("conv_id", F.lit(0).cast("bigint").alias("at"), F.unhex(F.lit(_ROOT)).alias("name"))
    for piece in reversed(pieces):
        known = known.withColumn("at", F.col("at") * 2)
        below = known.join(piece.withColumnRenamed("name", "piece"), ["conv_id", "at"]).select(
            "conv_id", (F.col("at") + 1).alias("at"), _digest("name", "piece").alias("name"))
        known = stored(known.unionByName(below))
    return known.withColumnRenamed("at", "depth")


def _totals(nodes: DataFrame, prefixes: DataFrame, height: int, values: list[str]) -> DataFrame:
    """``(name, depth, *values)``: ``values`` of ``nodes`` summed over subtrees.
    ``nodes`` has ``(name, depth, conv_id, *values)``, ``conv_id`` a member."""
    def of(k: int) -> Column:
        return F.col("depth") % (1 << k) == 0

    sums = [F.sum(v).alias(f"_{v}") for v in values]
    added = [(F.col(v) + F.coalesce(F.col(f"_{v}"), F.lit(0))).alias(v) for v in values]
    whole = nodes.select("name", "depth", "conv_id", *values)
    tries = []  # per k: what tries of height 2^k sum to, and the node 2^k turns above
    for k in range(height):
        above = prefixes.where(of(k)).select("conv_id", (F.col("depth") + (1 << k)).alias("depth"), F.col("name").alias("above"))
        tries.append(stored(whole.join(above, ["conv_id", "depth"], "left")))
        lower = tries[k].where(~of(k + 1)).groupBy(F.col("above").alias("name")).agg(*sums)
        whole = tries[k].where(of(k + 1)).join(lower, "name", "left").select("name", "depth", "conv_id", *added)
    total = whole.select("name", "depth", *values)
    for k in reversed(range(height)):
        total = stored(total)
        hung = (total.select("name", *values).join(tries[k].where(of(k + 1) & F.col("above").isNotNull()).select("name", "above"), "name")
                .groupBy(F.col("above").alias("name")).agg(*sums))
        half = tries[k].where(~of(k + 1)).join(hung, "name", "left").select("name", "depth", *added)
        total = total.unionByName(half)
    return total


def _hashed(ends: DataFrame) -> DataFrame:
    """``(name, ends_sha256)`` of ``(name, conv_id)``: the ids of each name,
    ascending and comma-joined.  Ranges of (name, id) split a name with many ids;
    each task joins its ids to texts, and only those pass one after the other
    through the digest."""
    def join(batches):
        for b in batches:
            if not b.num_rows:
                continue
            names, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in cuts[:-1]], pa.binary()), pa.array([ids[i] for i in cuts[:-1]], pa.int64()),
                 pa.array([",".join(map(str, ids[i:j])) for i, j in zip(cuts, cuts[1:])], pa.string())], names=["name", "first", "ids"])

    def digest(batches):
        name = state = None
        for b in batches:
            out = []
            for x, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if x != name:
                    if state:
                        out.append((name, state.hexdigest()))
                    name, state = x, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            if out:
                yield _pairs(out)
        if state:
            yield _pairs([(name, state.hexdigest())])

    def _pairs(rows):
        names, texts = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(texts, pa.string())], names=["name", "ends_sha256"])

    texts = (ends.select("name", "conv_id").repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
             .mapInArrow(join, "name binary, first bigint, ids string"))
    return texts.repartition("name").sortWithinPartitions("name", "first").mapInArrow(digest, "name binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame | None = None) -> DataFrame:
    """One row per node: ``(conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256)``.

    ``turns``: ``(conv_id, pos, mark, chars)`` as of ``number_turns``, positions from
    0 without gaps; ``convs``: ``(conv_id)``, one row each, of all conversations,
    those without turns included (default: those of ``turns``).  A node is a
    distinct sequence of first turns, the root the empty one; its members are the
    conversations that begin with it.  ``conv_id``: the smallest member, which
    names the node among those of its depth; ``parent_conv_id``: the parent's (NULL
    for the root); ``n_leaves``: childless nodes in its subtree, itself included;
    ``saved_tokens``: (members - 1) times the code points of the last text, summed
    over its subtree; ``ends_sha256``: SHA-256 of the decimal ids of the members
    that end here, ascending, comma-joined.  Without conversations there is no
    node, not even the root."""
    turns = turns.select("conv_id", "pos", "mark", "chars")
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    if convs is not None:
        lengths = convs.select("conv_id").join(lengths, "conv_id", "left").select("conv_id", F.coalesce("n", F.lit(0)).alias("n"))
    lengths = stored(lengths)
    height = int(lengths.agg(F.max("n")).first()[0] or 0).bit_length()
    prefixes = _prefixes(lengths, _pieces(turns, height)[:height])
    ends = prefixes.join(lengths.select("conv_id", F.col("n").alias("depth")), ["conv_id", "depth"])
    nodes = prefixes.groupBy("name", "depth").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    # the turn behind a prefix is the last of the next one, whose parent the prefix is
    steps = prefixes.join(turns.select("conv_id", F.col("pos").alias("depth"), "chars"), ["conv_id", "depth"]).select(
        "conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"), "chars")
    nodes = stored(nodes.join(steps, ["conv_id", "depth"], "left"))
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    own = nodes.select("name", "depth", "conv_id", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
                       ((F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0))).alias("saved_tokens"))
    totals = _totals(own, prefixes, height, ["n_leaves", "saved_tokens"]).drop("depth")
    parents = nodes.where(F.col("n_children") > 0).select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
                                                          F.col("n_children").alias("shared"))
    found = join_counted(nodes, parents, "parent", "shared", nodes.count(), "left")
    return (found.join(totals, "name").join(_hashed(ends), "name", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))
