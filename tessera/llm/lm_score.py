"""Stupid-backoff language-model scores, as joins of n-grams with their counts.

    S(w | context) = c(context w) / c(context)   if c(context w) >= min_count
                   = 0.4 S(w | shorter context)  otherwise;  S(w) = c(w) / N

Three steps, each a shuffle:

1. Documents are dealt into blocks.  A block lists the distinct n-grams (64-bit
   hashes, orders 1 to ``order``) of its documents with their counts in it.
2. The lists are partitioned by hash range and order, and counts are summed:
   the count tables.  Each list is answered by the counts of its n-grams, in its
   order (0 for those below ``min_count``, which back off).
3. A block joins its documents' n-grams, in the same order, with the answers and
   sums the scores of each document.

Rows carry sorted hash lists, cut by block and hash range, instead of one
n-gram each: under 6 bytes an n-gram instead of 30.  No table is broadcast or
collected; a block and a hash range are bounded by ``block_chars``, whatever
the corpus, and a very frequent n-gram is one entry in each block's list.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import BASE, U64, WordHashes, id_text, mix, packed, unpacked

ALPHA = 0.4


# ---------------------------------------------------------- sorted hashes ---

def _squeezed(values: np.ndarray) -> bytes:
    """64-bit values byte plane by byte plane, entropy-coded: planes that are zero
    or nearly constant cost next to nothing."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, 8).T.tobytes())


def _stretched(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(U64).ravel()


def pack(sorted_hashes: np.ndarray) -> bytes:
    """Ascending 64-bit values, as differences."""
    return _squeezed(np.diff(sorted_hashes, prepend=U64(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(_stretched(data), dtype=U64)


def pack_counts(counts: np.ndarray) -> bytes:
    return _squeezed(counts.astype(U64))


def unpack_counts(data: bytes) -> np.ndarray:
    return _stretched(data).view(np.int64)


# ---------------------------------------------------------------- n-grams ---

def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words."""
    if k == 1:
        return words
    if len(words) < k:
        return words[:0]
    h = words[:len(words) - k + 1].copy()
    for j in range(1, k):
        h = mix(h * U64(BASE) + words[j:len(words) - k + 1 + j])
    return h


def _runs(h: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of a sorted array begin."""
    return np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)


def _tables(texts: list[bytes], order: int):
    """Per order: distinct hashes (ascending) and their counts in ``texts``."""
    hashes = WordHashes()
    docs = [hashes.of(t.split()) for t in texts]
    for k in range(1, order + 1):
        h = np.sort(np.concatenate([grams(d, k) for d in docs]))
        at = _runs(h)
        yield k, h[at], np.diff(np.append(at, len(h)))


def _requests(order: int, ranges: int, counting: bool):
    """Step 1: the lists of one block, cut into hash ranges."""
    cuts = np.array([(i << 64) // ranges for i in range(1, ranges)], U64)

    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        block = key[0].as_py()
        out = []
        for k, h, c in _tables(unpacked(table), order):
            c = c if counting else np.zeros_like(c)
            for i, (hs, cs) in enumerate(zip(np.split(h, np.searchsorted(h, cuts)), np.split(c, np.searchsorted(h, cuts)))):
                if len(hs):
                    out.append((i, k, block, pack(hs), pack_counts(cs)))
        part, k, b, h, c = zip(*out) if out else ((),) * 5
        return pa.table({"part": pa.array(part, pa.int32()), "k": pa.array(k, pa.int32()), "block": pa.array(b, pa.int32()),
                         "hashes": pa.array(h, pa.binary()), "counts": pa.array(c, pa.binary())})

    return ask


def _answers(min_count: int):
    """Step 2: one hash range of one order.  A list is answered by its counts
    alone, in its order: the block that asked can rebuild the hashes."""
    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part, k = (x.as_py() for x in key)
        lists = [unpack(x) for x in table.column("hashes").to_pylist()]
        every = np.concatenate(lists)
        order = np.argsort(every, kind="stable")  # the lists are sorted: a merge
        at = _runs(every[order])
        counts = np.concatenate([unpack_counts(x) for x in table.column("counts").to_pylist()])
        total = np.add.reduceat(counts[order], at)
        total[total < (1 if k == 1 else min_count)] = 0
        each = np.empty(len(every), np.int64)
        each[order] = np.repeat(total, np.diff(np.append(at, len(every))))
        ends = np.cumsum([len(x) for x in lists])
        out = [(block, k, part, pack_counts(each[e - len(h):e])) for block, asks, h, e in
               zip(table.column("block").to_pylist(), table.column("asks").to_pylist(), lists, ends) if asks]
        b, k, p, c = zip(*out) if out else ((),) * 4
        return pa.table({"block": pa.array(b, pa.int32()), "k": pa.array(k, pa.int32()), "part": pa.array(p, pa.int32()),
                         "counts": pa.array(c, pa.binary())})

    return answer


def _scores(order: int, alpha: float):
    """Step 3: one block's documents and the counts it got."""
    def score(docs: pa.Table, counts: pa.Table) -> pa.Table:
        hashes = WordHashes()
        words = [hashes.of(t.split()) for t in unpacked(docs)]
        answers = sorted(zip(*(counts.column(c).to_pylist() for c in ("k", "part", "counts"))), key=lambda r: r[:2])
        per_doc = []
        for k in range(1, order + 1):
            asked = [grams(w, k) for w in words]
            ends = np.cumsum([len(x) for x in asked])
            h = np.concatenate(asked)
            at = np.argsort(h)
            runs = _runs(h[at])
            # hash ranges in order: the counts of the block's distinct n-grams, ascending
            own = [unpack_counts(c) for j, _, c in answers if j == k]
            found = np.empty(len(h), np.int64)
            found[at] = np.repeat(np.concatenate(own) if own else np.zeros(0, np.int64), np.diff(np.append(runs, len(h))))
            per_doc.append(np.split(found, ends[:-1]))
        out = [(len(w), *_document([x[i] for x in per_doc], len(w), alpha)) for i, w in enumerate(words)]
        n, total, bare = zip(*out)
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(n, pa.int64()),
                         "log_score": pa.array(total, pa.float64()), "bare": pa.array(bare, pa.int64())})

    return score


def _document(counts: list[np.ndarray], n: int, alpha: float) -> tuple[float, int]:
    """``(sum of log scores but for log N, positions that came down to c(w) / N)``
    of ``n`` words, from the counts of the document's n-grams by order.  A word
    that the corpus lacks counts as seen half a time."""
    if not n:
        return 0.0, 0
    log = np.zeros(n)
    open_ = np.ones(n, bool)  # not decided by a longer n-gram
    for k in range(len(counts), 1, -1):
        c = counts[k - 1]
        if not len(c):
            continue
        at = np.arange(k - 1, n)  # last word of each n-gram
        hit = open_[at] & (c > 0)
        log[at[hit]] += np.log(c[hit]) - np.log(np.maximum(counts[k - 2][:len(c)][hit], 1))
        open_[at[hit]] = False
        missed = at[open_[at]]
        log[missed] += math.log(alpha)
    log[open_] += np.log(np.maximum(counts[0][open_], 0.5))
    return float(math.fsum(log)), int(open_.sum())


# --------------------------------------------------------------- operator ---

def _n_blocks(texts: DataFrame, chars: int) -> int:
    return max(1, -(-(texts.agg(F.sum(F.length("text"))).first()[0] or 0) // chars))


def _blocks(texts: DataFrame, n: int) -> DataFrame:
    """``(doc_id, data, block)``: packed texts dealt into ``n`` blocks."""
    keyed = packed(texts)
    return keyed.withColumn("block", F.pmod(F.xxhash64("doc_id", "data"), F.lit(n)).cast("int")).repartition(n, "block")


def lm_score(docs: DataFrame, corpus: DataFrame | None = None, order: int = 3, min_count: int = 2, alpha: float = ALPHA,
             id_col: str = "doc_id", text_col: str = "text", block_chars: int = 1 << 24) -> DataFrame:
    """One row per document: ``(doc_id, n_words, log_score, mean_log_score)``.

    Counts come from all of ``corpus`` (default: ``docs`` itself), words are
    ``[^\\x20\\x09-\\x0D]+``, n-grams do not cross documents, and the first words
    of a document have shorter contexts.  ``log_score``: natural log of the
    product of S; the mean is per word and NULL for a text without words, whose
    sum is 0.  NULL texts are empty, NULL ids stay NULL, repeated rows are
    counted and scored each.  An empty corpus scores every word as half a
    sighting in one."""
    texts = id_text(docs, id_col, text_col)
    n = _n_blocks(texts, block_chars)
    blocks = _blocks(texts, n)  # one exchange, for the requests and for the scores
    lists = "part int, k int, block int, hashes binary, counts binary"
    other = corpus is not None and id_text(corpus, id_col, text_col)
    ranges = _n_blocks(other, block_chars) if other else n
    asked = blocks.groupBy("block").applyInArrow(_requests(order, ranges, not other), lists).withColumn("asks", F.lit(True))
    if other:
        asked = asked.unionByName(_blocks(other, ranges).groupBy("block").applyInArrow(_requests(order, ranges, True), lists)
                                  .withColumn("asks", F.lit(False)))
    answered = asked.groupBy("part", "k").applyInArrow(_answers(min_count), "block int, k int, part int, counts binary")
    scored = (blocks.groupBy("block").cogroup(answered.groupBy("block"))
              .applyInArrow(_scores(order, alpha), "doc_id bigint, n_words bigint, log_score double, bare bigint"))
    scored = cut_lineage(scored)
    if not other:
        words = scored.agg(F.sum("n_words")).first()[0]
    else:
        words = other.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    total = F.col("log_score") - F.col("bare") * F.lit(math.log(max(1, words or 0)))
    return scored.select("doc_id", "n_words", total.alias("log_score"),
                         F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_score"))
