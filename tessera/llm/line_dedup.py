"""Line dedup by deletion neighbourhoods.

A line goes if an earlier line (smaller document id, then smaller line number)
is equal to it or within one edit of it.

Two lines are within one edit exactly if, for some position, deleting the
character there from both gives the same text at the same place (a
substitution), or deleting a character of one gives the other.  Each distinct
line therefore emits all texts with one character deleted, as 64-bit hashes,
and its own hash; equal hashes meet by a shuffle, and

* rows that agree in hash and position are substitutions of each other,
* a line's own hash meets those of lines with one character more.

Only the earliest line of each kind matters to a row, so a group yields one
candidate a row, never pairs; candidates are verified by edit distance.

Emitting is restricted to lines that can have a partner: lines of n and m
characters, n <= m <= n + 1, within one edit share their first n // 2
characters or their last n - n // 2.  Hashes of these halves are counted first
(4 numbers a distinct line), and lines that share none are done.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_counted, width
from ..session import cut_lineage
from .common import BASE, U64, Powers, id_text, in_pieces, long_column, mix, packed, stored, unpacked

BLANKS = " \t\x0b\x0c\r"
_ID = ["h1", "h2"]  # 128 bits stand for a line
_STEP = Decimal(2**31)


def _lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, line)``: lines without outer blanks; empty ones are left out."""
    lines = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    return (lines.select("doc_id", "line_no", F.btrim("raw", F.lit(BLANKS)).alias("line"))
            .where(F.col("line") != ""))


def _place(doc_id: str, line_no: str) -> Column:
    """Order of lines as one number (fixed width in aggregation buffers)."""
    return (F.col(doc_id).cast("decimal(20,0)") * F.lit(_STEP) + F.col(line_no)).cast("decimal(38,0)")


def _halves(line: str, n: str) -> Column:
    """The half-line hashes of a line of ``n`` characters."""
    out = []
    for short in (F.col(n), F.col(n) - 1):
        head = F.floor(short / 2).cast("int")
        tail = (short - head).cast("int")
        out += [F.xxhash64(F.lit("head"), short, F.substr(F.col(line), F.lit(1), head)),
                F.xxhash64(F.lit("tail"), short, F.substr(F.col(line), F.col(n) - tail + 1, tail))]
    return F.array(*out)


def distinct_lines(lines: DataFrame, min_chars: int) -> DataFrame:
    """``(h1, h2, first, rows, halves)``: distinct lines with the place of the
    earliest, their number and, from ``min_chars`` on, their half-line hashes."""
    n = F.length("line").alias("n")
    rows = lines.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                        _place("doc_id", "line_no").alias("place"), n, "line")
    rows = rows.withColumn("halves", F.when(F.col("n") >= min_chars, _halves("line", "n")))
    each = [F.col("halves")[i].alias(f"half{i}") for i in range(4)]
    found = rows.select(*_ID, "place", *each).groupBy(*_ID).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"), *[F.first(f"half{i}").alias(f"half{i}") for i in range(4)])
    return found


def _with_partners(distinct: DataFrame) -> DataFrame:
    """``(first)`` of the lines that share a half with another line."""
    halves = (distinct.where(F.col("half0").isNotNull())
              .select("first", F.explode(F.array(*[f"half{i}" for i in range(4)])).alias("half")))
    shared = cut_lineage(halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    total = shared.agg(F.sum("n")).first()[0] or 0
    return join_counted(halves, shared, "half", "n", total).select("first").distinct()


# ------------------------------------------------------------- variants ---

def variants(line: str, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, position)`` of a line's own text (position -1) and of the text
    without the character at each position."""
    c = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(U64)
    n = len(c)
    p = powers.prefix(c)
    # without character i: what lies before keeps its power, what lies behind loses one
    less = p[:-1] + (p[-1] - p[1:]) * powers.inverse[1]
    length = [U64(k * BASE % 2**64) for k in (n, n - 1)]
    own = mix(np.append(p[-1:] + length[0], less + length[1]))
    return own, np.arange(-1, n, dtype=np.int32)


_KEYS = 1 << 18  # variants held at once, about 24 bytes each


def _emit(batches):
    """(doc_id, line_no, line) -> (hash, pos, doc_id, line_no).  What is held is bounded by
    the variants, not by the lines: a line has as many as characters."""
    powers = Powers()
    powers.reach(2)

    def rows(out):
        h, pos, d, i = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays([long_column(h), pa.array(pos), pa.array(d), pa.array(i)],
                                          names=["hash", "pos", "doc_id", "line_no"])

    out, held = [], 0
    for b in in_pieces(batches, 100):
        for doc_id, line_no, line in zip(*(b.column(i).to_pylist() for i in range(3))):
            h, pos = variants(line, powers)
            for at in range(0, len(h), _KEYS):  # a line of megabytes goes in portions
                n = len(h[at:at + _KEYS])
                out.append((h[at:at + _KEYS], pos[at:at + _KEYS], np.full(n, doc_id, np.int64), np.full(n, line_no, np.int32)))
                held += n
                if held >= _KEYS:
                    yield rows(out)
                    out, held = [], 0
    if out:
        yield rows(out)


def _first_in(group: np.ndarray, rank: np.ndarray, use: np.ndarray) -> np.ndarray:
    """For every row, the least ``rank`` among the rows of its ``group`` (numbered
    ascending) with ``use``; a large number if there is none."""
    out = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(out, group[use], rank[use])
    return out[group]


def _earlier(h, pos, doc_id, line_no):
    """Rows that have an earlier partner in their hash group, and that partner."""
    order = np.lexsort((line_no, doc_id))
    rank = np.empty(len(h), np.int64)
    rank[order] = np.arange(len(h))
    group = np.cumsum(np.append(0, h[1:] != h[:-1]))
    same = np.cumsum(np.append(0, (h[1:] != h[:-1]) | (pos[1:] != pos[:-1])))
    own = pos < 0
    best = np.minimum(_first_in(same, rank, ~own),  # a substitution at the same place
                      _first_in(group, rank, own))  # one character less
    best = np.where(own, _first_in(group, rank, ~own), best)  # or one more
    hit = best < rank
    return np.flatnonzero(hit), order[best[hit]]


def _candidates(batches):
    """Sorted (hash, pos, doc_id, line_no) -> (doc_id, line_no, to_doc, to_line)."""
    held = None
    for table in _columns(batches):
        cols = table if held is None else [np.concatenate(x) for x in zip(held, table)]
        cut = int(np.searchsorted(cols[0], cols[0][-1], "left"))
        held = [c[cut:] for c in cols]
        if cut:
            yield from _answer([c[:cut] for c in cols])
    if held is not None:
        yield from _answer(held)


def _columns(batches):
    for b in batches:
        if b.num_rows:
            yield [np.asarray(b.column(i)) for i in range(4)]


def _answer(cols):
    at, to = _earlier(*cols)
    if len(at):
        _, _, d, i = cols
        found = np.unique(np.stack([d[at], i[at].astype(np.int64), d[to], i[to].astype(np.int64)], 1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1].astype(np.int32)), pa.array(found[:, 2]),
                                          pa.array(found[:, 3].astype(np.int32))], names=["doc_id", "line_no", "to_doc", "to_line"])


def near_lines(lines: DataFrame) -> DataFrame:
    """``(doc_id, line_no)`` of the lines -- distinct, by first occurrence -- that
    have an earlier one within one edit."""
    keyed = lines.mapInArrow(_emit, "hash bigint, pos int, doc_id bigint, line_no int")
    found = cut_lineage(keyed.repartition(width(lines), "hash").sortWithinPartitions("hash", "pos").mapInArrow(
        _candidates, "doc_id bigint, line_no int, to_doc bigint, to_line int").distinct())
    text = lines.select("doc_id", "line_no", "line")
    to = text.select(F.col("doc_id").alias("to_doc"), F.col("line_no").alias("to_line"), F.col("line").alias("to_text"))
    per = cut_lineage(to.join(found.groupBy("to_doc", "to_line").agg(F.count(F.lit(1)).alias("n")), ["to_doc", "to_line"]))
    pairs = join_counted(found, per, ["to_doc", "to_line"], "n", found.count()).join(text, ["doc_id", "line_no"])

    def verify(batches):
        for b in in_pieces(batches, 100):
            near = [within_one(x, y) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield b.filter(pa.array(near, pa.bool_())).select([0, 1])

    # Spark's own edit distance takes quadratic time on long lines even with a bound
    checked = pairs.select("doc_id", "line_no", "line", "to_text").mapInArrow(verify, "doc_id bigint, line_no int")
    return checked.distinct()


def within_one(a: str, b: str) -> bool:
    """Whether one insertion, deletion or substitution at most makes ``a`` of ``b``: what
    follows their common beginning is equal but for one character."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    lo, hi = 0, len(a)  # the common beginning, by halves
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    return a[lo + (len(a) == len(b)):] == b[lo + 1:]


# ------------------------------------------------------------- operator ---

def line_dedup(docs: DataFrame, min_chars: int = 4, id_col: str = "doc_id", text_col: str = "text", edits: int = 1) -> DataFrame:
    """One row per document: ``(doc_id, n_lines, n_removed, removed, kept_text)``.

    Lines end at U+000A and are compared without outer blanks; blank lines are
    never removed.  A line goes if an earlier one is equal, or -- both having at
    least ``min_chars`` characters, below which one edit makes another word --
    within one insertion, deletion or substitution, whether or not the earlier
    one goes itself.  ``edits`` 0: only equal lines go; a bound above 1 is not
    supported.  ``removed``: the numbers of the removed lines, ascending;
    ``kept_text``: the others joined by U+000A.  A NULL text is one blank line;
    a document with a NULL id has no place in the order: it loses nothing and
    causes no loss.  Rows that repeat an id are one document; of equal lines at
    one place the number of the line decides, so both lose or keep it."""
    if edits not in (0, 1):
        raise ValueError("edits must be 0 or 1")
    texts = id_text(docs, id_col, text_col)
    distinct = stored(distinct_lines(_lines(texts), min_chars if edits else 1 << 31))
    picked = _with_partners(distinct)
    doc_of = F.floor(F.col("first") / F.lit(_STEP)).cast("bigint").alias("doc_id")
    line_of = (F.col("first") - F.floor(F.col("first") / F.lit(_STEP)) * F.lit(_STEP)).cast("int").alias("line_no")
    wanted = picked.select(doc_of, line_of).groupBy("doc_id").agg(F.collect_list("line_no").alias("wanted"))

    def pick(batches):
        for b in in_pieces(batches):
            found = []
            for doc_id, text, numbers in zip(b.column(0).to_pylist(), unpacked(b), b.column(2).to_pylist()):
                lines = text.decode().split("\n")
                found += [(doc_id, i, lines[i].strip(BLANKS)) for i in numbers if i < len(lines)]
            if found:
                d, i, line = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int32()), pa.array(line, pa.string())],
                                                 names=["doc_id", "line_no", "line"])

    some = (packed(texts).join(wanted, "doc_id").mapInArrow(pick, "doc_id bigint, line_no int, line string")
            .dropDuplicates(["doc_id", "line_no"]))
    near = cut_lineage(near_lines(cut_lineage(some)))
    late = near.select(_place("doc_id", "line_no").alias("first"), F.lit(True).alias("near"))
    # what an occurrence must know of its line: the first place, and whether all go
    fates = (distinct.join(late, "first", "left").select(*_ID, "first", "rows", F.coalesce("near", F.lit(False)).alias("near"))
             .where((F.col("rows") > 1) | F.col("near")))
    fates = cut_lineage(fates)
    occurrences = _lines(texts).select("doc_id", "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
    told = join_counted(occurrences, fates, _ID, "rows", distinct.agg(F.sum("rows")).first()[0] or 0)
    gone = (told.where(F.col("near") | (_place("doc_id", "line_no") > F.col("first")))
            .groupBy("doc_id").agg(F.array_sort(F.collect_set("line_no")).alias("removed")))

    def cut(batches):
        for b in in_pieces(batches):
            n, kept, dropped = [], [], [x or [] for x in b.column(2).to_pylist()]
            for text, removed in zip(unpacked(b), dropped):
                lines, drop = text.decode().split("\n"), set(removed)
                n.append((len(lines), len(drop)))
                kept.append("\n".join([x for i, x in enumerate(lines) if i not in drop]))
            total, gone = zip(*n) if n else ((), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(dropped, pa.list_(pa.int32())),
                                              pa.array(kept, pa.string())],
                                             names=["doc_id", "n_lines", "n_removed", "removed", "kept_text"])

    return packed(texts).join(gone, "doc_id", "left").select("doc_id", "data", "removed").mapInArrow(
        cut, "doc_id bigint, n_lines bigint, n_removed bigint, removed array<int>, kept_text string")
