"""Periodic runs: stretches of words that repeat with a period.

A run is a maximal stretch with smallest period q (words q apart are equal) of
at least ``max(min_length, 2 q)`` words.  It shows as a diagonal of equal words:
at lag q, word i equals word i - q all along the run but its first q words.

The sparse diagonal table of a document has one entry per active lag: the
number of words matched so far.  Earlier occurrences of what has just been read
activate lags, matches lengthen them, and a diagonal that ends long enough is
a run.  Two things keep this from growing with the square of a repetitive text:

* A diagonal of lag d counts only if at least ``need >= d`` words match, so it
  passes one of the places that are ``step`` apart with a whole piece of 2^s
  words, ``2^s + step - 1 <= need``.  Lags from L to 2 L - 1 are activated only
  there, by the earlier occurrences of the piece that lie so far back: at most
  about three lags a word for each of the log n classes L.
* An active lag is lengthened by 2^k words at a time instead of one, forwards
  and backwards, by names of all pieces of 2^k words that occur twice in their
  document.  Names are given by sorting pairs of names, so equal names are equal
  words: no hashing.

A text of n words thus takes O(n log^2 n) steps whatever it repeats, and 4 bytes
a word for each doubling of its longest repeated piece.  Many documents go
through abreast, about a megabyte of text at a time; nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import by_bytes, id_text

_ROOM = 1 << 21  # candidate lags that are worked on at once


class Names:
    """Exact names of the pieces of 1, 2, 4, ... words that occur more than once in
    their document, for documents laid end to end.  ``levels[k]`` is ``(name,
    places)``: the name of the piece that starts at each word (-1: it occurs once,
    or its document ends before), and the starts ordered by name, then place."""

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        self.n = n = len(words)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        at, size = np.arange(n), 1
        key = doc.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
        while len(at):
            order = np.argsort(key, kind="stable")
            ranked = key[order]
            new = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
            count = np.diff(np.append(new, len(ranked)))
            twice = count > 1
            places = at[order[np.repeat(twice, count)]]
            if not len(places):
                return
            name = np.full(n + 1, -1, np.int32)
            name[places] = np.repeat(np.arange(int(twice.sum()), dtype=np.int32), count[twice])
            self.levels.append((name, places))
            left = np.sort(places)
            left = left[left + size < n]
            right = left + size
            both = (name[right] >= 0) & (doc[left] == doc[right])
            at, right, size = left[both], right[both], 2 * size
            key = name[at].astype(np.int64) * (int(twice.sum()) + 1) + name[right]

    def diagonals(self, i: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 word of the stretch around word ``i`` that equals what
        stands ``lag`` before it."""
        first, last = i.copy(), i.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            name, size = self.levels[k][0], 1 << k
            hit = name[last]
            hit = (hit >= 0) & (hit == name[last - lag])
            last[hit] += size
            back = first - size
            inside = back - lag >= 0
            hit = np.where(inside, name[back], -1)
            hit = (hit >= 0) & (hit == name[np.where(inside, back - lag, 0)])
            first[hit] -= size
        return first, last

    def active(self, low: int, need: int):
        """Places and lags from ``low`` to ``2 low - 1`` at which a diagonal of
        ``need`` or more words can be met, in portions."""
        s = (2 * (need + 1) // 3).bit_length() - 1
        if s >= len(self.levels):
            return
        name, places = self.levels[s]
        step = need - (1 << s) + 1
        which = np.flatnonzero(places % step == 0)
        here = places[which]
        row = name[places].astype(np.int64) * self.n
        ranked, base = row + places, row[which]
        lo = np.searchsorted(ranked, base + np.maximum(here - 2 * low + 1, 0))
        hi = np.searchsorted(ranked, base + here - low, "right")
        some = hi > lo
        here, lo, many = here[some], lo[some], (hi - lo)[some]
        total = np.cumsum(many)
        at = 0
        while at < len(here):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _ROOM, "right")))
            m = many[at:to]
            i = np.repeat(here[at:to], m)
            j = places[np.repeat(lo[at:to] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))]
            yield i, i - j
            at = to


def runs(words: np.ndarray, doc: np.ndarray, min_length: int = 12) -> np.ndarray:
    """``(start, end, period)`` rows, ordered by start and end, of the runs of
    documents laid end to end; ``words``: a number for each distinct word,
    ``doc``: the number of each word's document, ascending."""
    names = Names(words, doc)
    longest = int(np.bincount(doc).max()) if len(doc) else 0
    found = [np.zeros((0, 3), np.int64)]
    low = 1
    while 2 * low <= longest:
        need = min(max(d, min_length - d) for d in (low, min(2 * low - 1, max(low, min_length // 2))))
        for i, lag in names.active(low, need):
            first, last = names.diagonals(i, lag)
            match = last - first
            hit = (match >= lag) & (match + lag >= min_length)
            found.append(_rows(first[hit] - lag[hit], last[hit], lag[hit]))
        low *= 2
    out = _rows(*np.concatenate(found).T)
    # a multiple of a run's period has the same stretch
    return out[np.append(True, (out[1:, :2] != out[:-1, :2]).any(1))] if len(out) else out


def _rows(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Distinct rows, ordered."""
    order = np.lexsort((period, end, start))
    out = np.stack([start[order], end[order], period[order]], 1)
    return out[np.append(True, (out[1:] != out[:-1]).any(1))] if len(out) else out


def scan(texts: list[bytes], min_length: int = 12):
    """For each text: its words, its runs as ``(start, length, period)`` rows in
    words by start, then period, and which words stay when every run is cut to its
    first period (None: all)."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    split = [t.split() for t in texts]
    size = np.fromiter(map(len, split), np.int64, len(split))
    start = np.cumsum(size) - size
    words = np.fromiter((x for ws in split for x in map(number.__getitem__, ws)), np.int64, int(size.sum()))
    found = runs(words, np.repeat(np.arange(len(texts)), size), min_length)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, found[:, 0] + found[:, 2], 1)
    np.add.at(edges, found[:, 1], -1)
    keep = np.cumsum(edges)[:-1] == 0
    owner = np.searchsorted(start + size, found[:, 0], "right")
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    for k, ws in enumerate(split):
        own = found[cut[k]:cut[k + 1]]
        rows = np.stack([own[:, 0] - start[k], own[:, 1] - own[:, 0], own[:, 2]], 1)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
        yield ws, rows, keep[start[k]:start[k] + size[k]] if len(own) else None


def find_runs(docs: DataFrame, min_length: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``(doc_id, n_words, runs, collapsed_text)``.

    Words are ``[^\\x20\\x09-\\x0D]+``.  ``runs``: ``struct<start, length, period>`` of
    every run in words from 0, by start, then period.  A word goes from
    ``collapsed_text`` if a run contains it after that run's first period; the
    others are joined by one space.  NULL and blank texts have no words, a NULL id
    stays NULL, repeated rows give repeated rows."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    struct = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])

    def run(batches):
        for b, texts in by_bytes(batches):
            n, ends, rows, kept = [], [0], [], []
            for ws, own, keep in scan(texts, min_length):
                n.append(len(ws))
                ends.append(ends[-1] + len(own))
                rows.append(own)
                kept.append(b" ".join(ws if keep is None else compress(ws, keep.tolist())).decode())
            flat = np.concatenate(rows)
            found = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], fields=list(struct))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "runs", "collapsed_text"])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id bigint, n_words bigint, runs array<{kind}>, collapsed_text string")
