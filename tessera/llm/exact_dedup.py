"""Exact dedup in DataFrame operations only.

Texts are equal when identical after deleting ``[\\x20\\x09-\\x0D]``.  Groups are
formed by digest *and* normalised text at every stage, so a digest collision
never merges different texts:

1. locally: the map side of the first aggregation leaves one row per text and
   task (the salt is the task's partition, so it never splits a task's copies);
2. per salt: those rows meet in ``(digest, text, salt)`` groups -- a text held
   by a third of all rows is dealt over ``salts`` tasks;
3. globally: at most ``salts`` winners per text are combined.

Texts are shuffled in stages 1-3 only.  Documents then look up their group by
``(digest, bucket)``: a 63-bit mask, gathered with the winners, tells which
buckets of document ids a group has members in, so a group is repeated for
those only and a hot group's rows are dealt over 63 tasks.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SALTS = 64
_BUCKETS = 63  # bits of a non-negative bigint
_STEP = Decimal(2**65)  # above any id offset, see _rank


def normalised(text: Column) -> Column:
    """Text without ``[\\x20\\x09-\\x0D]``; NULL counts as empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for ch in ("\n", "\t", "\r", "\x0b", "\x0c", " "):
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def _rank(n: Column, doc_id: Column) -> Column:
    """Order of the copies as one number: more code points first, then the
    smaller id; a NULL id comes last.  A decimal is kept in a fixed-width
    aggregation buffer, so the aggregation stays a hash aggregation."""
    back = F.coalesce(F.lit(Decimal(2**63)) - doc_id.cast("decimal(20,0)"), F.lit(Decimal(0)))
    return (n.cast("decimal(12,0)") * F.lit(_STEP) + back).cast("decimal(38,0)")


def _id_of(rank: Column) -> Column:
    back = rank % F.lit(_STEP)
    return F.when(back > 0, (F.lit(Decimal(2**63)) - back).cast("bigint"))


def text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per distinct text: ``(digest, same, keep_id, group_size, mask)``;
    ``same`` is the text itself where its digest has several texts, else NULL."""
    rows = docs.select(
        normalised(F.col(text_col)).alias("norm"),
        _rank(F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), F.col(id_col).cast("bigint")).alias("rank"),
        _bucket(id_col).alias("bucket"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
    ).withColumn("digest", F.sha2("norm", 256))
    salted = rows.groupBy("digest", "norm", "salt").agg(
        F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n"),
        F.bit_or(F.expr("shiftleft(1L, bucket)")).alias("mask"))
    # one row per salt and text is left: dealing by digest puts a text's winners
    # and all texts of its digest together
    whole = salted.repartition("digest").groupBy("digest", "norm").agg(
        F.max("rank").alias("rank"), F.sum("n").alias("group_size"), F.bit_or("mask").alias("mask"))
    texts = F.count(F.lit(1)).over(Window.partitionBy("digest"))
    return whole.select("digest", F.when(texts > 1, F.col("norm")).alias("same"), _id_of(F.col("rank")).alias("keep_id"),
                        "group_size", "mask")


def _bucket(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col).cast("bigint")), F.lit(_BUCKETS)).cast("int")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: ``(doc_id, keep_id, group_size, kept, text_sha256)``.

    Of equal texts the row with the most code points, then the smallest id
    stays; rows with a NULL id rank last and are kept only if no other copy
    has an id and as many code points.  A NULL text equals an empty one.
    Repeated rows (same id, same text) count in ``group_size`` each and share
    their decision.  An empty input gives no rows."""
    groups = cut_lineage(text_groups(docs, id_col, text_col, salts))
    collided = groups.where(F.col("same").isNotNull()).limit(1).count() > 0
    member = groups.withColumn("bucket", F.explode(F.expr(
        f"filter(transform(sequence(0, {_BUCKETS - 1}), i -> int(i)), i -> getbit(mask, i) = 1)")))
    norm = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), _bucket(id_col).alias("bucket"),
                       F.sha2(norm, 256).alias("digest"), *([norm.alias("norm")] if collided else []))
    out = rows.join(member, ["digest", "bucket"])
    if collided:  # digests that belong to several texts: the text decides
        out = out.where(F.col("same").isNull() | (F.col("same") == F.col("norm")))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.col("digest").alias("text_sha256"))
