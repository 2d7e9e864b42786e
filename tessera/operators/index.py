"""Stored positional index and phrase search over it (TXT-02, TXT-03, JOI-12).

Documents are dealt into blocks of up to 1024, numbered where they lie.  The
index has three tables under one folder:

``postings``  one row per (word, block), or several where a block has millions of tokens:
              the sorted places of the word in the block's documents,
              ``slot << 32 | position``.  A frequent word has a row
              for each block, so no row and no task grows with the corpus.  Rows are
              in directories by a hash bucket of the word, sorted by word and block,
              and Parquet stores the places as bit-packed differences.
``words``     the directory: one row per word with its bucket and its number of
              rows in blocks, documents and places.
``docs``      (block, slot) -> doc_id.

Buckets follow the number of tokens; Spark's rebalancing splits a large bucket (a
hot word) over several files and joins small ones, so as many tasks write as the
data need.

A phrase is found by its rarest word: the directory tells which that is, its
places give the only possible starts, and each further word, ever more frequent,
is probed in the blocks that still have some.  No text and no token row of the
corpus takes part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .search import phrase_table, token_slices
from .skew import spread

BLOCK_BITS = 10
TOKENS_PER_BUCKET = 1 << 27
_PLACE = 32  # bits of a position; the slot stands above them
_AT_ONCE = 1 << 21  # tokens of a block whose postings are made at once


def number_docs(doc_toks: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """``(doc_id, toks)`` -> ``(doc_id, block, slot, toks)``: documents numbered in
    blocks of at most ``2^bits`` without a shuffle, each row on its own even if ids
    repeat; materialised once, as the numbers go by where a row lies."""
    row = F.monotonically_increasing_id()
    rows = doc_toks.select("doc_id", F.shiftright(row, bits).alias("block"), row.bitwiseAND((1 << bits) - 1).cast("int").alias("slot"), "toks")
    return cut_lineage(rows)


def _lists(held: list[pa.RecordBatch], block: int) -> pa.RecordBatch:
    """The postings of some documents of a block."""
    toks = pa.concat_arrays([b.column(2) for b in held])
    slot = np.concatenate([b.column(1).to_numpy() for b in held]).astype(np.int64)
    kinds, row = toks.flatten().dictionary_encode(), pc.list_parent_indices(toks).to_numpy()
    begin = np.searchsorted(row, np.arange(len(slot)))  # a document's first token among all
    place = slot[row] << _PLACE | (np.arange(len(row)) - begin[row])
    word = kinds.indices.to_numpy()
    order = np.lexsort((place, word)) if (np.diff(slot) < 0).any() else np.argsort(word, kind="stable")
    place, word = place[order], word[order]
    n = np.bincount(word, minlength=len(kinds.dictionary))
    fresh = np.append(True, (np.diff(word) != 0) | (np.diff(place >> _PLACE) != 0))[:len(word)]
    docs = np.bincount(word[fresh], minlength=len(n))
    ends = np.append(0, np.cumsum(n)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [kinds.dictionary, pa.array(np.full(len(n), block, np.int64)), pa.array(docs.astype(np.int32)), pa.array(n.astype(np.int32)),
         pa.ListArray.from_arrays(pa.array(ends), pa.array(place))], names=["word", "block", "n_docs", "n", "places"])


def postings(numbered: DataFrame) -> DataFrame:
    """``(word, block, n_docs, n, places)``.  A block's documents lie together in one task,
    so its lists are made there without a shuffle, of up to ``_AT_ONCE`` tokens at a
    time: a block with more has several rows for a word, of different documents."""
    def run(batches):
        held, block, tokens = [], None, 0
        for b in token_slices(batches, most=_AT_ONCE):
            blocks = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for i, j in zip(cuts, cuts[1:]):
                part = b.slice(i, j - i)
                if held and (blocks[i] != block or tokens >= _AT_ONCE):
                    yield _lists(held, block)
                    held, tokens = [], 0
                block = int(blocks[i])
                held.append(part)
                tokens += len(part.column(2).flatten())
        if held:
            yield _lists(held, block)

    return numbered.select("block", "slot", "toks").mapInArrow(run, "word string, block bigint, n_docs int, n int, places array<bigint>")


def write_index(numbered: DataFrame, path: str, tokens_per_bucket: int = TOKENS_PER_BUCKET) -> None:
    """Write the index of ``number_docs`` rows to ``path``."""
    spark = numbered.sparkSession
    tokens = numbered.agg(F.sum(F.size("toks").cast("bigint"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("word"), F.lit(max(1, -(-tokens // tokens_per_bucket)))).cast("int")
    rows = postings(numbered).withColumn("bucket", bucket)
    (rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word", "block")
     .write.option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary#places.list.element", "false")
     .partitionBy("bucket").parquet(f"{path}/postings"))
    counts = _postings(spark, path).groupBy("word", "bucket").agg(
        F.count(F.lit(1)).alias("blocks"), F.sum("n_docs").alias("docs"), F.sum("n").alias("places"))
    counts.hint("rebalance").sortWithinPartitions("word").write.parquet(f"{path}/words")
    numbered.select("block", "slot", "doc_id").sortWithinPartitions("block", "slot").write.parquet(f"{path}/docs")


def _postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word string, block bigint, n_docs int, n int, places array<bigint>, bucket int").parquet(f"{path}/postings")


_LISTED = 10_000


def _of_words(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Postings of ``wanted`` ``(bucket, word)``, distinct rows.  Up to ``_LISTED`` words are
    named to the scan, which reads their buckets only and skips row groups by word;
    more meet the postings in a join."""
    rows = _postings(spark, path)
    names = wanted.limit(_LISTED + 1).collect()
    if len(names) > _LISTED:
        return rows.join(wanted, ["bucket", "word"])
    return rows.where(F.col("bucket").isin(sorted({r["bucket"] for r in names})) & F.col("word").isin(sorted({r["word"] for r in names})))


def directory(spark: SparkSession, path: str) -> DataFrame:
    """``(word, bucket, blocks, docs, places)`` of every word of a stored index."""
    return spark.read.schema("word string, bucket int, blocks bigint, docs bigint, places bigint").parquet(f"{path}/words")


def _docs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/docs")


def read_index(spark: SparkSession, path: str, words: DataFrame) -> DataFrame:
    """``(word, doc_id, positions)`` of ``words`` (column ``word``): one row per word and
    document that has it.  Only buckets of these words are read."""
    wanted = cut_lineage(words.select("word").distinct().join(directory(spark, path), "word").select("bucket", "word"))
    rows = _of_words(spark, path, wanted)
    each = rows.select("word", "block", F.explode("places").alias("place"))
    lists = each.groupBy("word", "block", F.shiftright("place", _PLACE).cast("int").alias("slot")).agg(
        F.sort_array(F.collect_list(F.col("place").bitwiseAND((1 << _PLACE) - 1).cast("int"))).alias("positions"))
    return lists.join(_docs(spark, path), ["block", "slot"]).select("word", "doc_id", "positions")


def _starts(places: Column, offset: Column) -> Column:
    """Where the phrase would begin whose word ``offset`` stands at ``places``.  Before a
    document's first token that is no place of any word, so the phrase's first word,
    which stands at offset 0, rules it out."""
    return F.when(offset == 0, places).otherwise(F.transform(places, lambda p: p - offset))


def _ordered_words(spark: SparkSession, path: str, phrases: DataFrame, phrase: str, lower: bool) -> DataFrame:
    """``(phrase, n_tokens, step, offset, word, bucket)``: the words of the phrases all
    of whose words the index has, from the rarest on."""
    table = phrase_table(phrases.dropDuplicates([phrase]), phrase, lower)
    found = table.join(directory(spark, path).select("word", "bucket", "places"), "word")
    steps = found.groupBy("phrase", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("places", "offset", "word", "bucket"))).alias("steps"))
    return cut_lineage(steps.where(F.size("steps") == F.col("n_tokens")).select("phrase", "n_tokens", F.posexplode("steps").alias("step", "s"))
                       .select("phrase", "n_tokens", "step", "s.offset", "s.word", "s.bucket"))


def search_index(spark: SparkSession, path: str, phrases: DataFrame, phrase: str = "phrase", first_only: bool = True,
                 lower: bool = False) -> DataFrame:
    """TXT-03 / JOI-12 over a stored index: ``(phrase, doc_id, start, end)`` of every
    occurrence of the phrases (column ``phrase``), or of the first in each document
    with ``first_only``.  Tokens of a phrase are taken as given unless ``lower``;
    a phrase without tokens occurs nowhere.  The postings of the phrases' words are
    read once; then one join a word of the longest phrase, with one row per phrase
    and block on either side."""
    words = _ordered_words(spark, path, phrases, phrase, lower)
    longest = words.agg(F.max("n_tokens")).first()[0] or 1
    # the postings of the phrases' words, read once and dealt over the cores
    wanted = words.select("bucket", "word").distinct()
    rows = cut_lineage(spread(_of_words(spark, path, wanted).select("word", "block", "places")))

    def at(step: int) -> DataFrame:
        return words.where(F.col("step") == step).select("phrase", "n_tokens", "offset", "word")

    left = rows.join(at(0), "word").select("phrase", "n_tokens", "block", _starts(F.col("places"), F.col("offset")).alias("starts"))
    hits = left.where(F.col("n_tokens") == 1)
    for step in range(1, longest):
        # each step is read by the next one and by the result
        left = cut_lineage(left.where((F.col("n_tokens") > step) & (F.size("starts") > 0)))
        both = F.array_intersect("starts", _starts(F.col("places"), F.col("offset")))
        left = (rows.join(left.join(at(step).drop("n_tokens"), "phrase"), ["word", "block"])
                .select("phrase", "n_tokens", "block", both.alias("starts")))
        hits = hits.unionByName(left.where(F.col("n_tokens") == step + 1))
    each = hits.select("phrase", "n_tokens", "block", F.explode("starts").alias("place"))
    each = each.select("phrase", "n_tokens", "block", F.shiftright("place", _PLACE).cast("int").alias("slot"),
                       F.col("place").bitwiseAND((1 << _PLACE) - 1).cast("int").alias("start"))
    if first_only:  # once within a document's row, once among rows of one id
        each = each.groupBy("phrase", "n_tokens", "block", "slot").agg(F.min("start").alias("start"))
    found = each.join(_docs(spark, path), ["block", "slot"])
    if first_only:
        found = found.groupBy("phrase", "n_tokens", "doc_id").agg(F.min("start").alias("start"))
    return found.select("phrase", "doc_id", "start", (F.col("start") + F.col("n_tokens") - 1).alias("end"))
