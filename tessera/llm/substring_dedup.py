"""Substring dedup: windows of ``window`` words that a document with a smaller
id also has are removed.

Every window of every document is hashed (Rabin-Karp over the XXH64 of its words,
64 bits, wrap-around arithmetic), but only windows that can repeat are shuffled:

* A window's *anchor* is the smallest hash among its ``window // 2``-word
  sub-windows.  Equal windows have equal anchors.
* A *run* is a maximal row of consecutive windows with one anchor, told apart by
  the digest of all its words.  Spark counts runs by ``(anchor, run)`` and finds the
  smallest document of each; windows of runs are not counted one by one.
* A run that a smaller document has as a whole is removed as a whole.
* The remaining windows -- those of runs that are first of their kind and
  share their anchor with another kind (the ends of repeated passages) -- are
  counted one by one by ``(anchor, window)``; copies of a run never are.

About one word in thirteen starts a run, so a thirteenth of the windows is
shuffled plus the ends of repeated passages; keys held by many rows are joined
by ``join_counted``.  Removed windows merge into maximal intervals.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_counted
from ..session import cut_lineage
from .common import Powers, WordHashes, by_bytes, id_text, in_pieces, long_column, mix, packed, stored, unpacked


class Windows:
    """Hashes of the word windows of a text."""

    def __init__(self, window: int):
        self.window, self.part = window, max(1, window // 2)
        self.hashes, self.powers = WordHashes(), Powers()

    def of(self, text: bytes):
        """``(words, starts, ends, anchors, hashes)``: the words; the runs of windows,
        as first and last + 1 window, with their anchors; the hash of every window.
        None if there is no window."""
        words = text.split()
        n, w, k = len(words), self.window, self.part
        if n < w:
            return None
        prefix = self.powers.prefix(self.hashes.of(words))
        inverse = self.powers.inverse
        hashes = (prefix[w:] - prefix[:-w]) * inverse[:n - w + 1]
        parts = mix((prefix[k:] - prefix[:-k]) * inverse[:n - k + 1])
        least = _sliding_min(parts, w - k + 1)
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        starts, ends = np.append(0, cut), np.append(cut, len(least))
        return words, starts, ends, least[starts], hashes

    def digests(self, words: list[bytes], starts, ends) -> np.ndarray:
        """What tells the words from window ``starts`` up to window ``ends`` (exclusive) apart."""
        more = self.window - 1
        found = [blake2b(b" ".join(words[s:e + more]), digest_size=8).digest() for s, e in zip(starts.tolist(), ends.tolist())]
        return np.frombuffer(b"".join(found), np.int64)


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` consecutive values, by doubling."""
    out, have = x, 1
    while have < n:
        step = min(have, n - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _runs(texts: DataFrame, window: int) -> DataFrame:
    """``(anchor, run, doc_id)``: the runs of each document."""
    def emit(batches):
        hasher = Windows(window)
        for b, some in by_bytes(batches):
            anchor, run, ids = [], [], []
            for doc_id, text in zip(b.column(0).to_pylist(), some):
                if (found := hasher.of(text)) is not None:
                    words, starts, ends, anchors, _ = found
                    anchor.append(anchors)
                    run.append(hasher.digests(words, starts, ends))
                    ids.append(np.full(len(starts), doc_id, np.int64))
            if run:
                yield pa.RecordBatch.from_arrays([long_column(np.concatenate(anchor)), pa.array(np.concatenate(run)),
                                                  pa.array(np.concatenate(ids))], names=["anchor", "run", "doc_id"])

    return texts.where(F.col("doc_id").isNotNull()).mapInArrow(emit, "anchor bigint, run bigint, doc_id bigint")


def _marks(texts: DataFrame, window: int) -> DataFrame:
    """Per document: ``dead`` runs (a smaller document has them) and ``open``
    runs (first of their kind, with another kind of the same anchor)."""
    runs = stored(_runs(texts, window))
    kinds = cut_lineage(runs.groupBy("anchor", "run").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    anchors = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("rows"))
    anchors = cut_lineage(anchors.where(F.col("rows") > 1))
    # what a kind needs to know: whether its anchor has others
    telling = cut_lineage(join_counted(kinds, anchors, "anchor", "kinds", kinds.count())
                          .select("anchor", "run", "first", "n", (F.col("kinds") > 1).alias("shared")))
    told = join_counted(runs, telling, ["anchor", "run"], "n", runs.count())
    dead = F.col("doc_id") > F.col("first")
    return (told.where(dead | F.col("shared")).groupBy("doc_id")
            .agg(F.collect_set(F.when(dead, F.col("run"))).alias("dead"),
                 F.collect_set(F.when(~dead, F.col("run"))).alias("open")))


def _open_windows(texts: DataFrame, marks: DataFrame, window: int) -> DataFrame:
    """``(anchor, hash, words, doc_id)`` of the windows of open runs."""
    def emit(batches):
        hasher = Windows(window)
        for b in in_pieces(batches, 500):
            for doc_id, text, opened in zip(b.column(0).to_pylist(), unpacked(b), b.column(2).to_pylist()):
                if (found := hasher.of(text)) is None:  # another row of the id has the open run
                    continue
                words, starts, ends, anchors, hashes = found
                mine = np.isin(hasher.digests(words, starts, ends), np.array(opened, np.int64))
                at = np.flatnonzero(np.repeat(mine, ends - starts))  # runs follow each other
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [long_column(np.repeat(anchors, ends - starts)[at]), long_column(hashes[at]),
                         pa.array(hasher.digests(words, at, at + 1)), pa.array(np.full(len(at), doc_id, np.int64))],
                        names=["anchor", "hash", "words", "doc_id"])

    some = marks.where(F.size("open") > 0).select("doc_id", "open")
    return packed(texts).join(some, "doc_id").mapInArrow(emit, "anchor bigint, hash bigint, words bigint, doc_id bigint")


def _late_windows(texts: DataFrame, marks: DataFrame, window: int) -> DataFrame:
    """``(doc_id, late)``: windows of open runs that a smaller document has."""
    key = ["anchor", "hash", "words"]
    rows = stored(_open_windows(texts, marks, window).distinct())
    firsts = rows.groupBy(*key).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = cut_lineage(firsts.where(F.col("n") > 1))
    late = join_counted(rows, firsts, key, "n", rows.count()).where(F.col("doc_id") > F.col("first"))
    return late.groupBy("doc_id").agg(F.collect_list(F.struct("hash", "words")).alias("late"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """One row per document: ``(doc_id, n_words, n_removed, spans, kept_text)``.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A word goes if a window over it also starts
    in a document with a smaller id; windows are those of the input.  ``spans``:
    maximal removed intervals as ``struct<start, end>`` in words, end exclusive;
    ``kept_text``: the other words joined by one space.  NULL and blank texts
    have no words; a document with a NULL id has no place in the order, so it
    neither loses words nor causes a loss; rows that repeat an id are one
    document and remove nothing from each other."""
    texts = id_text(docs, id_col, text_col)
    marks = cut_lineage(_marks(texts, window))
    late = cut_lineage(_late_windows(texts, marks, window))
    known = marks.where(F.size("dead") > 0).select("doc_id", "dead").join(late, "doc_id", "full")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches):
        hasher = Windows(window)
        for b in in_pieces(batches, 500):
            counts, spans, kept = [], [], []
            for text, dead, windows in zip(unpacked(b), b.column(2).to_pylist(), b.column(3).to_pylist()):
                words = text.split()
                gone = _removed(hasher, text, dead or [], windows or []) if dead or windows else []
                left, at = [], 0
                for s, e in gone:
                    left += words[at:s]
                    at = e
                kept.append(b" ".join(left + words[at:]).decode())
                counts.append((len(words), sum(e - s for s, e in gone)))
                spans.append([{"start": s, "end": e} for s, e in gone])
            n, gone = zip(*counts) if counts else ((), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    return (packed(texts).join(known, "doc_id", "left").select("doc_id", "data", "dead", "late")
            .mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, "
                             "spans array<struct<start:int,end:int>>, kept_text string"))


def _removed(hasher: Windows, text: bytes, dead: list[int], late: list[dict]) -> list[tuple[int, int]]:
    """Maximal intervals of words under a removed window: those of ``dead`` runs and
    the ``late`` ones."""
    found = hasher.of(text)
    if found is None:
        return []
    words, starts, ends, _, hashes = found
    gone = np.zeros(len(hashes), bool)
    if dead:
        gone |= np.repeat(np.isin(hasher.digests(words, starts, ends), np.array(dead, np.int64)), ends - starts)
    if late:
        at = np.flatnonzero(np.isin(hashes.view(np.int64), np.array([x["hash"] for x in late], np.int64)))
        gone[at[np.isin(hasher.digests(words, at, at + 1), np.array([x["words"] for x in late], np.int64))]] = True
    at = np.flatnonzero(gone)
    if not len(at):
        return []
    first = np.append(True, at[1:] > at[:-1] + hasher.window)
    last = np.append(first[1:], True)
    return list(zip(at[first].tolist(), (at[last] + hasher.window).tolist()))
