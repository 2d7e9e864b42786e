"""SimHash near-dedup by Golay-code fuzzy hashing.

A document's 64-bit fingerprint is the bitwise majority of its shingle
hashes.  Fingerprints within 4 differing bits are linked.

Search.  The bits are cut into three segments (22, 21 and 21 bits, padded to
23).  The binary Golay code [23, 12, 7] is perfect with radius 3: around any
word there is one codeword within 3 bits, so two words that differ in at most
2 bits have a codeword within 4 bits of both (the one nearest to a midpoint).
Decoding a segment to *all* codeword indices within 4 bits (1 or 6 of them)
therefore gives equal keys for segments up to 2 bits apart.  Pigeonhole over
the segments for at most 4 errors in all:

* every segment has at most 2 errors: the three codeword indices agree
  (36-bit keys), or
* one segment has 3 or more: of the other two, one is free of errors and one
  has at most 1: an exact segment and a codeword index agree (33-bit keys).

Each distinct fingerprint emits these keys (about 180); equal keys meet by a
shuffle and every candidate is verified by its bit distance.  Copies never
meet: only distinct fingerprints do.  Within a key group, links are verified in
numpy and only a spanning forest of them is written, so a dense group costs
no rows beyond its members.  A group above ``block`` members is passed on and
compared as pairs of blocks, each pair a group of its own.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import component_edges
from ..operators.skew import join_counted, width
from ..session import cut_lineage
from .common import U64, id_text, in_pieces, long_column, utf8

MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, length
GOLAY_POLY = 0b101011100011  # x^11+x^9+x^7+x^6+x^5+x+1, a generator of the [23,12,7] code
BLOCK = 4096


# ------------------------------------------------------------ fingerprints ---

def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Majority of the shingles' XXH64 (seed 42) bits.  ``text`` is UTF-8;
    A-Z are lowered, words are ``[^\\x20\\x09-\\x0D]+``; fewer words than a shingle
    make one shingle, none make fingerprint zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts = ends - sizes
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), (ends[shingle - 1:] - 1).tolist())), U64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 65536):
        ones += np.unpackbits(h[i:i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(U64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``(doc_id, fp bigint)``, the fingerprint's bits as a signed number."""
    def run(batches):
        for b in in_pieces(batches):
            fps = np.array([fingerprint(t, shingle) for t in utf8(b)], U64)
            yield pa.RecordBatch.from_arrays([b.column(0), long_column(fps)], names=["doc_id", "fp"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fp bigint")


# -------------------------------------------------------------------- keys ---

def _syndrome(word: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words modulo the generator (11 bits)."""
    w = word.copy()
    for bit in range(22, 10, -1):
        w = np.where((w >> bit) & 1, w ^ (GOLAY_POLY << (bit - 11)), w)
    return w


@lru_cache(1)
def nearby_table() -> np.ndarray:
    """(2048, 6) error patterns of weight <= 4 by syndrome, padded with -1: a
    word XOR each of its syndrome's patterns is a codeword within 4 bits."""
    patterns = np.array([sum(1 << i for i in c) for w in range(5) for c in combinations(range(23), w)], np.int64)
    table = np.full((2048, 6), -1, np.int64)
    room = [0] * 2048
    for e, s in zip(patterns.tolist(), _syndrome(patterns).tolist()):
        table[s, room[s]] = e
        room[s] += 1
    return table


def nearby_codewords(segment: np.ndarray) -> np.ndarray:
    """(n, 6) indices (12 bits) of the codewords within 4 bits, -1 where none."""
    e = nearby_table()[_syndrome(segment)]
    return np.where(e < 0, -1, (segment[:, None] ^ e) >> 11)  # the code is systematic: the top 12 bits tell the codeword


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(key, position in fps)`` of every key of every fingerprint."""
    exact = [((fps >> U64(at)) & U64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    near = [nearby_codewords(s) for s in exact]
    keys, owners = [], []

    def put(kind: int, value: np.ndarray, ok: np.ndarray) -> None:
        keys.append((value + (kind << 40))[ok])
        owners.append(np.nonzero(ok)[0])

    for i in range(6):
        for j in range(6):
            for k in range(6):
                a, b, c = near[0][:, i], near[1][:, j], near[2][:, k]
                put(0, (a << 24) | (b << 12) | c, (a >= 0) & (b >= 0) & (c >= 0))
    kind = 0
    for x in range(3):
        for y in range(3):
            if x != y:
                kind += 1
                for j in range(6):
                    put(kind, (exact[x] << 12) | near[y][:, j], near[y][:, j] >= 0)
    return np.concatenate(keys), np.concatenate(owners)


# ------------------------------------------------------------------- links ---

def _forest(a: np.ndarray, max_bits: int, tied: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among ``a``: breadth-first, each member
    compared with those not reached yet.  ``tied``: block numbers; only members
    of different blocks (of a pair of blocks) are compared."""
    left = np.arange(len(a))
    src, dst = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            hit = np.bitwise_count(a[left] ^ a[i]) <= max_bits
            if tied is not None:
                hit &= tied[left] != tied[i]
            found = left[hit]
            if len(found):
                left = left[~hit]
                src.append(np.full(len(found), i))
                dst.append(found)
                queue.extend(found.tolist())
    return (np.concatenate(src), np.concatenate(dst)) if src else (np.zeros(0, np.int64),) * 2


def _links(group: np.ndarray, fp: np.ndarray, max_bits: int, small: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``group``: all of them in groups of up to
    ``small`` members (vectorised over the groups), else spanning forests."""
    at = np.nonzero(np.r_[True, group[1:] != group[:-1]])[0]
    size = np.diff(np.r_[at, len(group)])
    out_a, out_b = [], []
    some = (size > 1) & (size <= small)
    rest, rest_size = at[some], size[some]
    first = np.repeat(rest, rest_size) + _ramp(rest_size)
    end = np.repeat(rest + rest_size, rest_size)
    for d in range(1, small):
        ok = first + d < end
        first, end = first[ok], end[ok]
        if not len(first):
            break
        hit = np.bitwise_count(fp[first] ^ fp[first + d]) <= max_bits
        out_a.append(fp[first[hit]])
        out_b.append(fp[first[hit] + d])
    for s, n in zip(at[size > small], size[size > small]):
        a = fp[s:s + n]
        i, j = _forest(a, max_bits)
        out_a.append(a[i])
        out_b.append(a[j])
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (np.zeros(0, U64),) * 2


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``sizes``, one after another."""
    total = int(sizes.sum())
    return np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _runs(batches, block: int):
    """From batches sorted by key: ``(keys, fps, large)``, whole groups; a group
    above ``block`` members comes in parts marked ``large``."""
    held_k, held_f, large = np.zeros(0, np.int64), np.zeros(0, U64), None
    for b in batches:
        k = np.r_[held_k, b.column(0).to_numpy()]
        f = np.r_[held_f, b.column(1).to_numpy().view(U64)]
        if large is not None:  # the group that is too large may go on
            n = int(np.searchsorted(k, large, "right"))
            if n:
                yield k[:n], f[:n], True
            if n == len(k):
                held_k, held_f = k[:0], f[:0]
                continue
            k, f, large = k[n:], f[n:], None
        if not len(k):
            continue
        cut = int(np.searchsorted(k, k[-1], "left"))
        if cut:
            yield k[:cut], f[:cut], False
        held_k, held_f = k[cut:], f[cut:]
        if len(held_k) > block:
            large = held_k[0]
            yield held_k, held_f, True
            held_k, held_f = k[:0], f[:0]
    if len(held_k):
        yield held_k, held_f, False


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``(src, dst)``: verified links among distinct fingerprints ``(fp)``, as
    many as connect the same fingerprints as all links do."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys cover up to {MAX_BITS} differing bits")

    def emit(batches):
        for b in in_pieces(batches, 2000):
            fps = b.column(0).to_numpy().view(U64)
            k, own = keys_of(fps)
            yield pa.RecordBatch.from_arrays([pa.array(k), long_column(fps[own])], names=["key", "fp"])

    def meet(batches):
        for k, f, large in _runs(batches, block):
            if large:
                yield pa.RecordBatch.from_arrays([pa.array(k), long_column(f), pa.array(np.ones(len(k), bool))],
                                                 names=["src", "dst", "large"])
                continue
            a, b = _links(k, f, max_bits)
            if len(a):
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([long_column(pairs[:, 0]), long_column(pairs[:, 1]),
                                                  pa.array(np.zeros(len(pairs), bool))], names=["src", "dst", "large"])

    # a fingerprint becomes about 180 rows: dealt out first, few as they are
    p = width(distinct)
    keyed = distinct.select("fp").repartition(p, "fp").mapInArrow(emit, "key bigint, fp bigint")
    met = cut_lineage(keyed.repartition(p, "key").sortWithinPartitions("key")
                      .mapInArrow(meet, "src bigint, dst bigint, large boolean"))
    near = met.where(~F.col("large")).select("src", "dst")
    wide = met.where("large").select(F.col("src").alias("key"), F.col("dst").alias("fp"))
    return near.unionByName(_block_links(wide, max_bits, block)).distinct()


def _block_links(members: DataFrame, max_bits: int, block: int) -> DataFrame:
    """Links of large key groups: members are dealt into blocks of about
    ``block`` and every pair of blocks is compared as a group of its own."""
    if members.limit(1).count() == 0:
        return members.select(F.col("key").alias("src"), F.col("fp").alias("dst"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    sizes = cut_lineage(sizes.withColumn("blocks", F.ceil(F.col("n") / (block // 2)).cast("int")))
    rows = join_counted(members, sizes, "key", "n", members.count())
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = (rows.withColumn("mine", mine).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "fp"))

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(U64)
        mine = table.column("mine").to_numpy()
        a, b = _forest(fp, max_bits, None if key[1].as_py() == key[2].as_py() else mine)
        return pa.table({"src": long_column(fp[a]), "dst": long_column(fp[b])})

    return pairs.groupBy("key", "i", "j").applyInArrow(compare, "src bigint, dst bigint")


# ---------------------------------------------------------------- operator ---

def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                  max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``(doc_id, fingerprint, component_id, kept)``.

    ``fingerprint``: 16 lower-case hex digits; ``component_id``: smallest id
    reachable over links of at most ``max_bits`` differing bits (itself
    included); ``kept``: whether the document is that one.  NULL and blank texts
    have fingerprint zero and link like any other.  Rows with a NULL id take
    part in no group of their own: they get the component of their fingerprint
    and are not kept (if it has no id at all, NULL).  Repeated rows share their
    result.  An empty input gives no rows."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    distinct = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    parents = component_edges(links(distinct, max_bits))
    rooted = (distinct.join(parents.select(F.col("x").alias("fp"), F.col("y").alias("root")), "fp", "left")
              .select("fp", "first", "n", F.coalesce("root", "fp").alias("root")))
    rooted = cut_lineage(rooted)
    small = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("fps"))
    named = cut_lineage(join_counted(rooted, cut_lineage(small), "root", "fps", rooted.count())
                        .select("fp", "n", "component_id"))
    out = join_counted(fps, named, "fp", "n", fps.count())
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
