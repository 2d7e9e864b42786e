"""The registered queries of this subpackage over the driver's tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import join_counted
from ..session import checkpoint_dir
from ..sources.tables import table
from . import (common, embedding_dedup, exact_dedup, line_dedup, lm_score, mixing, periodic, pieces, prefix_trie, quality,
               rans, secrets, simhash, substring_dedup)

#: Where the tokenizers' vocabulary files lie.
TOKENIZERS = os.environ.get("TESSERA_TOKENIZERS", "/opt/tokenizers")
PIECES = os.path.join(TOKENIZERS, "piece_bpe_32k.model")
BYTES = os.path.join(TOKENIZERS, "byte_bpe_50k.json")


@dataclass(frozen=True)
class LlmQuery:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def _spans(column: str) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                  s["end"].cast("string"))), ",")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the counts of all documents."""
    return lm_score.lm_score(table(spark, sf_dir, "documents"), order=3, min_count=2)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document; the allow list hides no secret beside it."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def n(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(_spans("base"), 256).alias("base_sha256"), _spans("spans").alias("spans"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of one label with cosine 0.98 or more."""
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, with a check that decoding returns its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_and_check(docs, PIECES)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are within one edit of an earlier line."""
    cut = line_dedup.line_dedup(table(spark, sf_dir, "documents"), min_chars=4)
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
           FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id)
"""


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents."""
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words that an earlier document has."""
    cut = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), window=50)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document in a mix that repeats no source more than four times."""
    return mixing.mix(table(spark, sf_dir, "documents"), mixing.Target(repetition=4.0))


def planted_periods(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with the end of some texts made periodic: with
    h = crc32(decimal doc_id), h % 10 = 0 and g = h // 10, each of the n words from
    a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8)."""
    h = F.crc32(F.col("doc_id").cast("bigint").cast("string"))
    some = docs.select("doc_id", "text", F.coalesce(h, F.lit(1)).alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    g = F.floor(F.col("h") / 10)
    split = some.select("doc_id", "text", g.alias("g"), words.alias("words"), F.size(words).alias("n"))
    split = split.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    split = split.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    a, p = F.col("a").cast("int"), F.col("p")
    again = F.concat(F.slice("words", 1, a),
                     F.transform(F.sequence(F.lit(0), F.col("n") - a - 1), lambda i: F.get(F.col("words"), a + i % p)))
    return split.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, some made periodic."""
    found = periodic.find_runs(planted_periods(table(spark, sf_dir, "documents")), min_length=12)
    # the longest, then the first, then the one with the smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                              (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                                   r["period"].cast("string"), )), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
                       F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(turns, convs)`` of the rebuilt conversations: with h = crc32(decimal c) % 6,
    conversation c gets the first h turns of conversation c - c % 100 (all if fewer,
    none if absent), then its own from turn h on."""
    base = (F.col("conv_id") - F.col("conv_id") % 100).alias("base")
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).alias("h")
    turns = turns.select("*", base, h)
    lengths = common.stored(turns.groupBy("conv_id", "base", "h").agg(F.count(F.lit(1)).alias("n")))
    per_base = common.stored(lengths.groupBy("base").agg(
        F.sum("n").alias("rows"), F.coalesce(F.max(F.when(F.col("conv_id") == F.col("base"), F.col("n"))), F.lit(0)).alias("have")))
    first = turns.where((F.col("conv_id") == F.col("base")) & (F.col("pos") < 5)).select("base", "pos", "mark", "chars")
    before = lengths.join(first, "base").where(F.col("pos") < F.col("h")).select("conv_id", "pos", "mark", "chars")
    total = per_base.agg(F.sum("rows")).first()[0] or 0
    own = join_counted(turns, per_base, "base", "rows", total).where(F.col("pos") >= F.col("h"))
    after = own.select("conv_id", (F.col("pos") - F.col("h") + F.least("h", "have")).alias("pos"), "mark", "chars")
    return common.stored(before.unionByName(after)), lengths.select("conv_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(*rebuilt_turns(prefix_trie.number_turns(table(spark, sf_dir, "conversations"))))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to files and read again."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    rans.write(table(spark, sf_dir, "documents"), folder, BYTES, end_id=2)
    return rans.digests(spark, folder)


QUERIES: dict[str, LlmQuery] = {
    "op1_lm_score": LlmQuery(op1_lm_score),
    "op2_secret_scan": LlmQuery(op2_secret_scan),
    "op3_embedding_dedup": LlmQuery(op3_embedding_dedup),
    "op4_sentencepiece": LlmQuery(op4_sentencepiece),
    "op5_line_dedup": LlmQuery(op5_line_dedup),
    "op6_exact_dedup": LlmQuery(op6_exact_dedup, OP6_SQL),
    "op7_simhash_dedup": LlmQuery(op7_simhash_dedup),
    "op8_quality": LlmQuery(op8_quality),
    "op9_substring_dedup": LlmQuery(op9_substring_dedup),
    "op10_mixing": LlmQuery(op10_mixing),
    "op11_periodic_runs": LlmQuery(op11_periodic_runs),
    "op12_prefix_trie": LlmQuery(op12_prefix_trie),
    "op13_token_files": LlmQuery(op13_token_files),
}
