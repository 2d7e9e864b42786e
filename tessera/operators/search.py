"""Word count, positional index and phrase search (AGG-13, TXT-01 .. TXT-03).

Whole texts are processed: a document becomes an array of kept tokens
(bounded by that document's length) and ``posexplode`` turns it into
``(doc_id, pos, word)`` rows, so the corpus is spread over tasks by
document.  ``index.py`` stores a positional index and searches it;
``phrase_search`` here is for token rows that are searched once.  It joins them
with the phrase-token table; whether that side is broadcast is left to Spark's
own size check; beyond it AQE splits the partition of a frequent word, as both
sides are plain shuffles of stored rows.  Matches are grouped by
``(phrase, doc, pos - offset)`` -- a partial aggregate.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.scalar import code_map, jvm_split
from ..functions.text import whitespace_tokens
from ..session import cut_lineage
from .skew import spread, width

# Line terminators of a text file reader.
LINE_BREAK = "\\r\\n|\\r|\\n"


def text_lines(docs: DataFrame, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """Texts -> lines, as a line-oriented text reader sees them (a final line
    break does not open an empty last line)."""
    body = F.regexp_replace(F.col(text), f"(?:{LINE_BREAK})\\z", "")
    return spread(docs.select(*keep, text)).select(*keep, F.explode(F.split(body, LINE_BREAK, -1)).alias("line"))


def word_count(lines: DataFrame, line: str = "line", sep: str = " ", regex: bool = False) -> DataFrame:
    """AGG-13 + GEN-04: ``(word, count)`` with the JVM split rule (trailing
    empties dropped, interior empties counted as the word '')."""
    words = lines.select(F.explode(jvm_split(F.col(line), sep, regex)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


class _Kept(dict):
    """A lower-cased piece between white space -> its token by STR-05, or the empty string.
    Pieces recur, so they are kept until there are ``room``."""

    room = 500_000

    def __missing__(self, piece: str) -> str:
        if len(self) >= self.room:
            self.clear()
        i, n = 0, len(piece)
        while i < n and piece[i] != "_" and unicodedata.category(piece[i])[0] not in "LN":
            i += 1
        j = i
        while j < n and "a" <= piece[j] <= "z":
            j += 1
        token = self[piece] = piece[i:j]
        return token


def doc_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """TXT-01 per document: ``(doc_id, toks)`` with the kept tokens in order, as
    ``index_tokens`` finds them; a word that recurs is looked up, not matched again."""
    def run(batches):
        kept = _Kept()
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                flat, ends = [], [0]
                for body in part.column(1).to_pylist():
                    if body is not None:  # ``split()`` cuts at the white space of ``WHITESPACE_CLASS``
                        flat += filter(None, map(kept.__getitem__, body.split()))
                    ends.append(len(flat))
                toks = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.string()), mask=part.column(1).is_null())
                yield pa.RecordBatch.from_arrays([part.column(0), toks], names=["doc_id", "toks"])

    rows = spread(docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text).cast("string")).alias("text")))
    kind = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), StructField("toks", ArrayType(StringType()))])
    return rows.mapInArrow(run, kind)


def _explode_rows(df: DataFrame, keep, arr, names) -> DataFrame:
    """``posexplode`` that evaluates the array expression once.

    For an inner explode Spark infers a ``size(arr) > 0`` filter and pushes
    it below the projection, which re-runs an expensive array expression
    (the tokeniser regex) up to three times per document.  The outer form
    gets no inferred filter; empty arrays give one NULL row, dropped here."""
    out = df.select(*keep, F.posexplode_outer(arr).alias(*names))
    return out.where(F.col(names[1]).isNotNull())


def token_rows(doc_toks: DataFrame) -> DataFrame:
    """Token arrays -> ``(doc_id, pos, word)``."""
    return _explode_rows(doc_toks, ["doc_id"], F.col("toks"), ("pos", "word"))


def tokenize(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """TXT-01: ``(doc_id, pos, word)``; positions count kept tokens only."""
    return token_rows(doc_tokens(docs, doc_id, text))


def build_index(tokens: DataFrame) -> DataFrame:
    """TXT-02 / AGG-28: ``(word, doc_id, positions)`` with sorted positions.
    A posting list covers one document, so its size is bounded by the text."""
    return tokens.groupBy("word", "doc_id").agg(F.array_sort(F.collect_list("pos")).alias("positions"))


def phrase_table(phrases: DataFrame, phrase: str = "phrase", lower: bool = False) -> DataFrame:
    """Phrase -> ``(phrase, offset, word, n_tokens)``.  Query tokens are used
    as given (the reference does not normalise them, Q17) unless ``lower``."""
    p = F.lower(F.col(phrase)) if lower else F.col(phrase)
    toks = phrases.select(F.col(phrase).alias("phrase"), whitespace_tokens(p).alias("toks"))
    return toks.select("phrase", F.size("toks").alias("n_tokens"), F.posexplode("toks").alias("offset", "word"))


def phrase_search(tokens: DataFrame, phrases: DataFrame, phrase: str = "phrase", first_only: bool = True,
                  lower: bool = False) -> DataFrame:
    """TXT-03 / JOI-12: ``(phrase, doc_id, start, end)`` for every occurrence
    (or the first per document with ``first_only``).  Unlike the reference's
    single greedy scan, every true occurrence is found (Q17)."""
    pt = cut_lineage(phrase_table(phrases, phrase, lower))
    hits = tokens.join(pt, "word").select("phrase", "n_tokens", "doc_id",
                                          (F.col("pos") - F.col("offset")).alias("start"), "offset")
    full = (hits.groupBy("phrase", "doc_id", "start", "n_tokens")
                .agg(F.count(F.lit(1)).alias("k"))  # a token stands at one offset of a start
                .where(F.col("k") == F.col("n_tokens")))
    if first_only:
        full = full.groupBy("phrase", "doc_id", "n_tokens").agg(F.min("start").alias("start"))
    return full.select("phrase", "doc_id", "start", (F.col("start") + F.col("n_tokens") - 1).alias("end"))


def next_position(positions, start):
    """WIN-09: smallest position greater than ``start`` (NULL if none)."""
    p = F.col(positions) if isinstance(positions, str) else positions
    s = F.col(start) if isinstance(start, str) else start
    return F.array_min(F.filter(p, lambda x: x > s))


def previous_position(positions, start):
    """WIN-09: largest position smaller than ``start`` (NULL if none)."""
    p = F.col(positions) if isinstance(positions, str) else positions
    s = F.col(start) if isinstance(start, str) else start
    return F.array_max(F.filter(p, lambda x: x < s))


def _gram_array(n: int):
    """Array of the n-grams of the ``toks`` column (consecutive kept tokens
    joined by a space), built inside the array with ``zip_with``."""
    toks = F.col("toks")
    size = F.size(toks)
    grams = toks
    for j in range(1, n):
        length = F.greatest(size - j, F.lit(0))
        grams = F.zip_with(F.slice(grams, F.lit(1), length), F.slice(toks, F.lit(j + 1), length),
                           lambda a, b: F.concat(a, F.lit(" "), b))
    return grams


def ngrams(doc_toks: DataFrame, n: int = 2) -> DataFrame:
    """``(doc_id, pos, phrase)``: every run of ``n`` consecutive kept tokens,
    built inside each document's token array (no join, no shuffle)."""
    return _explode_rows(doc_toks, ["doc_id"], _gram_array(n), ("pos", "phrase"))


def top_ngrams(doc_toks: DataFrame, n: int = 2, k: int = 5) -> DataFrame:
    """The ``k`` most frequent n-grams (ties by text): ``(phrase, freq)``, in this
    order; the limit is the feature (a top-k report)."""
    best = top_ngrams_multi(cut_lineage(doc_toks.select("toks")), {n: k})
    return best.select("phrase", "freq").orderBy(F.desc("freq"), F.asc("phrase"))


_BUCKET_BITS = 17
_FIRST = 4096      # buckets of each n that are counted exactly at first
_AT_ONCE = 1 << 20  # tokens


def token_slices(batches, column: str = "toks", most: int = _AT_ONCE):
    """Batches in slices of about ``most`` tokens, at least one row each."""
    for b in batches:
        size = pc.fill_null(pc.list_value_length(b.column(b.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        share = np.cumsum(size, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            if i < j:
                yield b.slice(i, j - i)


def _gram_places(toks: pa.ListArray, sizes):
    """``(n, words, at, bucket)`` for each n: the tokens of all rows, where among them
    an n-gram of one row begins, and the buckets of these n-grams by their hash."""
    words, row = toks.flatten(), pc.list_parent_indices(toks).to_numpy()
    kinds = words.dictionary_encode()
    names = pd.util.hash_array(kinds.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    each = names[kinds.indices.to_numpy()]
    for n in sizes:
        starts = len(words) - n + 1
        if starts <= 0:
            continue
        h = np.zeros(starts, np.uint64)
        for j in range(n):
            h = (h ^ each[j:j + starts]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        at = np.flatnonzero(row[:starts] == row[n - 1:])
        yield n, words, at, (h[at] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)


def _bucket_counts(doc_toks: DataFrame, sizes) -> dict[int, np.ndarray]:
    """For each n, how many n-grams of the corpus fall into each bucket."""
    def run(batches):
        held = {n: np.zeros(1 << _BUCKET_BITS, np.int64) for n in sizes}
        for b in token_slices(batches):
            for n, _, _, bucket in _gram_places(b.column(0), sizes):
                held[n] += np.bincount(bucket, minlength=1 << _BUCKET_BITS)
        for n, count in held.items():
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), n, np.int32)), pa.array(some), pa.array(count[some])],
                                             names=["n", "bucket", "freq"])

    rows = (doc_toks.select("toks").mapInArrow(run, "n int, bucket bigint, freq bigint")
            .groupBy("n", "bucket").agg(F.sum("freq").alias("freq")).toArrow())
    out = {n: np.zeros(1 << _BUCKET_BITS, np.int64) for n in sizes}
    for n, held in out.items():
        own = rows.filter(pc.equal(rows["n"], n))
        held[own["bucket"].to_numpy()] = own["freq"].to_numpy()
    return out


def _counted(doc_toks: DataFrame, wanted: dict[int, np.ndarray]) -> DataFrame:
    """``(n, phrase, freq)`` of every n-gram whose bucket is ``wanted``."""
    def run(batches):
        for b in token_slices(batches):
            for n, words, at, bucket in _gram_places(b.column(0), wanted):
                at = at[wanted[n][bucket]]
                if len(at):
                    found = pc.binary_join_element_wise(*(words.take(pa.array(at + j)) for j in range(n)), " ").value_counts()
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), n, np.int32)), found.field("values"), found.field("counts")],
                                                     names=["n", "phrase", "freq"])

    rows = doc_toks.select("toks").mapInArrow(run, "n int, phrase string, freq bigint")
    return rows.groupBy("n", "phrase").agg(F.sum("freq").alias("freq"))


def _best(counts: DataFrame, ks: dict[int, int], salts: int) -> DataFrame:
    """The first of each n, picked in two steps -- within salts, then among the salts'
    winners -- so no window sees more than a salt's share of the n-grams."""
    best = [F.desc("freq"), F.asc("phrase")]
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    most = max(ks.values())  # a literal bound first: Spark then keeps that many rows a group before it sorts
    local = salted.withColumn("r", F.row_number().over(Window.partitionBy("n", "salt").orderBy(*best))).where(F.col("r") <= most)
    top = local.withColumn("r", F.row_number().over(Window.partitionBy("n").orderBy(*best))).where(F.col("r") <= most)
    return top.where(F.col("r") <= code_map("n", ks)).select("n", "phrase", "freq")


def top_ngrams_multi(doc_toks: DataFrame, ks: dict[int, int]) -> DataFrame:
    """Top-k n-grams for several n: ``(n, phrase, freq)``, ties by text.

    Exact over all n-grams without a row for each: one pass counts them by buckets of
    their hash, and a bucket's count is a bound for every n-gram in it.  Those of the
    fullest buckets are counted by their text; the least frequent of their best k then
    tells which further buckets may hold a better one, and these are counted too --
    all of them where no n-gram stands out.  ``doc_toks`` (column ``toks``) is read two
    or three times and should be stored."""
    sizes, salts = sorted(ks), width(doc_toks)
    bounds = _bucket_counts(doc_toks, sizes)
    first = {n: np.zeros(len(c), bool) for n, c in bounds.items()}
    for n, c in bounds.items():
        first[n][np.argpartition(c, -_FIRST)[-_FIRST:]] = True
    best = cut_lineage(_best(_counted(doc_toks, first), ks, salts))
    least = {r["n"]: r["least"] for r in best.groupBy("n").agg(F.min("freq").alias("least"), F.count(F.lit(1)).alias("k")).collect()
             if r["k"] == ks[r["n"]]}
    more = {n: ~first[n] & (c >= max(1, least.get(n, 1))) for n, c in bounds.items()}
    if not any(m.any() for m in more.values()):
        return best
    return _best(best.unionByName(_best(_counted(doc_toks, more), ks, salts)), ks, salts)
