"""A training corpus from raw documents, stage by stage.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)``,
works on all documents that the stage before it kept, and returns a DataFrame
that is written as Parquet and read again as the next one's ``docs``.  All but
the last return the columns of ``documents``.  NULL texts count as empty; the
dedup stages keep one row of each group, whatever its ids (a NULL id comes last);
an empty table passes through every stage.
"""

from __future__ import annotations

import os
import sys
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.llm import exact_dedup, mixing, pieces, quality, simhash  # noqa: E402
from tessera.llm.common import stored  # noqa: E402
from tessera.llm.queries import PIECES, LlmQuery  # noqa: E402
from tessera.session import checkpoint_dir  # noqa: E402
from tessera.sources.tables import table  # noqa: E402

THRESHOLD = 0.3  # of quality, below which a document goes
REPETITION = 1.5  # passes over the most repeated source, at most; no document is left out


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at ``THRESHOLD`` or above."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, out="_score").where(F.col("_score") >= THRESHOLD).select(*docs.columns)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each row, ``_row``, written before it is used: rows
    are told apart whatever their ids."""
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()))


def _first(keyed: DataFrame, groups: DataFrame, *order: Column) -> DataFrame:
    """Of each group (``_row``, ``_group``) the first row of ``keyed`` by ``order``,
    then the smallest id, NULL last, then the row; columns without ``_row``."""
    doc_id = F.col("doc_id").cast("bigint")
    rows = keyed.select("_row", F.struct(*order, doc_id.isNull(), doc_id, "_row").alias("_order"))
    best = rows.join(groups, "_row").groupBy("_group").agg(F.min("_order").alias("_order")).select("_order._row")
    return keyed.join(best, "_row", "left_semi").drop("_row")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original, then the smallest id: one row."""
    keyed = _keyed(docs.withColumn("_length", F.length(F.coalesce(F.col("text").cast("string"), F.lit("")))))
    found = exact_dedup.exact_dedup(keyed, id_col="_row")
    groups = found.select(F.col("doc_id").alias("_row"), F.col("keep_id").alias("_group"))
    return _first(keyed, groups, -F.col("_length")).drop("_length")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group, the smallest id."""
    keyed = _keyed(docs)
    found = simhash.simhash_dedup(keyed, id_col="_row", shingle=4, max_bits=4)
    groups = found.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))
    return _first(keyed, groups)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed by temperature, every document at least once."""
    return mixing.realise(docs, mixing.mix(docs, mixing.Target(repetition=REPETITION)))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, exact)`` of every document of the mix."""
    return pieces.encode_and_check(docs, PIECES)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_dedup", near_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

#: SQL cannot train the classifier of the first stage, so tests compare the
#: stages with brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the
    shared checkpoint folder."""
    checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERY = LlmQuery(run, ORACLE_SQL)
