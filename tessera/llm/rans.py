"""Token ids as entropy-coded files (static range asymmetric numeral system).

``write`` tokenizes documents, puts their ids into ascending id order and writes
them as a table of *segments*; the readers read it on any cluster.  Documents are
dealt by ranges of their id, so every task writes the segments of one range and
nothing passes through one task.

A segment holds up to 2^22 consecutive ids.  Its frequency table, scaled to 2^20,
is shared by its blocks of 2^16 ids, which are coded independently; the ids of a
block go in turn to 64 interleaved coders, each a 64-bit state that gives up 32
bits at a time.  Every 256 turns the states and the place in the stream are
kept: a *checkpoint*, from which decoding can start.  All blocks of a segment are
encoded, and all stretches between checkpoints decoded, abreast in numpy.  A
CRC-32 of each block's ids is verified whenever a whole block has been read.

Layout of a segment's ``data``, little-endian: 8 numbers (u32: magic, ids, ids a
block, coders, turns between checkpoints, log2 of the scale, symbols, bytes of the
table); the table, zstd (symbols as differences, then frequencies, u32); per block
its words and its CRC-32 (u32); per checkpoint its word (u32); per checkpoint
the states (u64 each); the words (u32).  Beside it stand the part (range of
ids), the place of the segment in the part, and the documents with their number
of ids in the segment.
"""

from __future__ import annotations

import json
import os
import zlib
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BASE, U64, by_bytes, id_text, mix, stored

SEGMENT, BLOCK, CODERS, EVERY, SCALE = 1 << 22, 1 << 16, 64, 256, 20
_MAGIC = 0x31524E54
_LOW, _WORD = U64(1 << 31), U64(32)
_U32 = np.dtype("<u4")
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)  # the first k of 8 bytes


# ------------------------------------------------------------------ coder ---

def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies of at least 1 that sum to 2^scale, near the shares of ``counts`` (all over 0)."""
    if len(counts) >= 1 << scale:
        raise ValueError(f"{len(counts)} symbols do not fit a table of 2^{scale}")
    out = 1 + counts.astype(np.int64) * ((1 << scale) - len(counts)) // int(counts.sum())
    out[np.argmax(out)] += (1 << scale) - int(out.sum())
    return out


def _encode_blocks(at: np.ndarray, freq: np.ndarray, first: np.ndarray):
    """``at``: (blocks, turns, coders) places in the table.  Returns the words of all
    blocks, their number by (turn, block), and the states before every
    ``EVERY``-th turn as (checkpoints, blocks, coders)."""
    blocks, turns, coders = at.shape
    state = np.full((blocks, coders), _LOW)
    words, owner, count, states = [], [], np.zeros((turns, blocks), np.int64), []
    for t in range(turns - 1, -1, -1):
        s = at[:, t]
        f = freq.take(s)
        full = state >> U64(63 - SCALE) >= f
        words.append(state[full].astype(_U32))
        count[t] = full.sum(1)
        owner.append(np.repeat(np.arange(blocks, dtype=np.uint16), count[t]))
        state >>= full * _WORD
        q = state // f
        # q 2^SCALE + (state mod f) + first
        state += q * (U64(1 << SCALE) - f) + first.take(s)
        if t % EVERY == 0:
            states.append(state.copy())
    # the decoder wants them by block, then turn, then coder
    order = np.argsort(np.concatenate(owner[::-1]), kind="stable")
    return np.concatenate(words[::-1])[order], count, np.stack(states[::-1])


def encode(ids: np.ndarray) -> bytes:
    """One segment of at most ``SEGMENT`` ids (u32)."""
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    symbols = np.flatnonzero(counts)
    freq = scaled(counts[symbols]) if len(ids) else np.zeros(0, np.int64)
    place = np.zeros(len(counts), np.int32)
    place[symbols] = np.arange(len(symbols), dtype=np.int32)
    first = (np.cumsum(freq) - freq).astype(U64)
    whole = len(ids) // BLOCK * BLOCK
    words, sizes, checks, offsets, states = [], [], [], [], []
    for part, length in ((ids[:whole], BLOCK), (ids[whole:], len(ids) - whole)):
        if not len(part):
            continue
        turns = -(-length // CODERS)
        at = np.full((len(part) // length, turns * CODERS), int(np.argmax(freq)), np.int32)  # the rest of the last turn
        at[:, :length] = place[part].reshape(-1, length)
        w, count, kept = _encode_blocks(at.reshape(len(at), turns, CODERS), freq.astype(U64), first)
        words.append(w)
        sizes.append(count.sum(0))
        before = np.cumsum(count, 0) - count
        offsets.append(before[::EVERY].T.ravel())
        states.append(kept.transpose(1, 0, 2).ravel())
        checks += [zlib.crc32(b) for b in part.astype(_U32).reshape(-1, length)]
    table = zstandard.ZstdCompressor(level=3).compress(
        np.concatenate([np.diff(symbols, prepend=0), freq]).astype(_U32).tobytes())
    head = np.array([_MAGIC, len(ids), BLOCK, CODERS, EVERY, SCALE, len(symbols), len(table)], _U32)

    def put(arrays, kind) -> bytes:
        return b"".join([np.asarray(a).astype(kind).tobytes() for a in arrays])

    return b"".join([head.tobytes(), table, put(sizes, _U32), put([checks], _U32), put(offsets, _U32), put(states, "<u8"), put(words, _U32)])


def decode(data: bytes, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """The ids (u32) of a segment, or those from ``lo`` to ``hi``, for which only the
    stretches between checkpoints that hold them are read.  Blocks that are read
    whole are checked: ValueError if a sum differs."""
    magic, n, block, coders, every, scale, kinds, size = np.frombuffer(data, _U32, 8).tolist()
    if magic != _MAGIC:
        raise ValueError("no token segment")
    hi = n if hi is None else min(hi, n)
    if lo >= hi:
        return np.zeros(0, _U32)
    table = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[32:32 + size]), _U32)
    symbols, freq = np.cumsum(table[:kinds], dtype=np.int64).astype(_U32), table[kinds:].astype(U64)
    first = np.cumsum(freq, dtype=U64) - freq
    slots = np.repeat(np.arange(kinds, dtype=np.int32), freq.astype(np.int64))
    blocks = -(-n // block)
    lengths = np.full(blocks, block)
    lengths[-1] = n - (blocks - 1) * block
    turns = -(-lengths // coders)
    stops = -(-turns // every)  # checkpoints of each block
    at = 32 + size

    def take(count: int, kind) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    sizes, checks = take(blocks, _U32).astype(np.int64), take(blocks, _U32)
    offsets, states = take(int(stops.sum()), _U32).astype(np.int64), take(int(stops.sum()) * coders, "<u8").reshape(-1, coders)
    words = take(int(sizes.sum()), _U32)
    # every stretch: its block, first id, turns, place in the words
    of = np.repeat(np.arange(blocks), stops)
    turn = (np.arange(len(of)) - np.repeat(np.cumsum(stops) - stops, stops)) * every
    begin = of * block + turn * coders
    steps = np.minimum(every, turns[of] - turn)
    wanted = np.flatnonzero((begin < hi) & (np.minimum(begin + steps * coders, of * block + lengths[of]) > lo))
    place = (np.cumsum(sizes) - sizes)[of] + offsets
    out = np.zeros(blocks * block, _U32)
    for k in np.unique(steps[wanted]).tolist():
        rows = wanted[steps[wanted] == k]
        got = symbols[_stretch(states[rows].astype(U64), place[rows], k, words, slots, freq, first, scale)]
        for b, ids in zip(begin[rows].tolist(), got):
            out[b:b + len(ids)] = ids[:max(0, len(out) - b)]
    whole = np.bincount(of[wanted], minlength=blocks) == stops
    for b in np.flatnonzero(whole).tolist():
        if zlib.crc32(out[b * block:b * block + int(lengths[b])].astype(_U32)) != int(checks[b]):
            raise ValueError(f"checksum of block {b} differs")
    return out[lo:hi]


def _stretch(state, place, steps: int, words, slots, freq, first, scale: int) -> np.ndarray:
    """``steps`` turns from the given states (stretches, coders): places in the table."""
    out = np.empty((len(state), steps, state.shape[1]), np.int32)
    mask, shift, flat = U64((1 << scale) - 1), U64(scale), state.reshape(-1)
    for t in range(steps):
        slot = state & mask
        s = slots.take(slot.view(np.int64))
        out[:, t] = s
        state >>= shift
        state *= freq.take(s)
        state += slot - first.take(s)
        empty = state < _LOW
        count = empty.sum(1)
        after = np.cumsum(count)
        at = np.flatnonzero(empty)
        word = np.arange(len(at)) + np.repeat(place - after + count, count)
        flat[at] = (flat.take(at) << _WORD) | words.take(word, mode="clip")  # clip: damaged words run on
        place = place + count
    return out.reshape(len(out), -1)


# -------------------------------------------------------------- tokenizer ---

class _Column:
    """Numbers that are appended to, with room ahead; ``all``: those there are."""

    def __init__(self, kind) -> None:
        self.all = self.room = np.zeros(0, kind)

    def __len__(self) -> int:
        return len(self.all)

    def append(self, more: np.ndarray) -> None:
        n, m = len(self.all), len(self.all) + len(more)
        if m > len(self.room):
            self.room = np.zeros(2 * m, self.room.dtype)
            self.room[:n] = self.all
        self.room[n:m] = more
        self.all = self.room[:m]


class _Pieces:
    """Pieces of text (bytes) -> numbers, in the order they are first met.

    Those of up to 16 bytes are found abreast: ``slots`` is a table with linear
    probing that holds numbers, and the two halves kept for each number are
    compared, so a hash never decides.  Longer ones are found one by one."""

    def __init__(self) -> None:
        self.long: dict[bytes, int] = {}
        self.low, self.high, self.short = _Column(U64), _Column(U64), _Column(bool)
        self.slots = np.full(1 << 10, -1, np.int32)

    def __len__(self) -> int:
        return len(self.low)

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix(low ^ high * U64(BASE)) & U64(len(self.slots) - 1)).view(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out, left, at = np.full(len(low), -1, np.int64), np.arange(len(low)), self._slot(low, high)
        while len(self) and len(left):
            n = self.slots.take(at)
            taken = n >= 0
            same = taken & (self.low.all.take(n, mode="clip") == low) & (self.high.all.take(n, mode="clip") == high)
            out[left[same]] = n[same]
            on = np.flatnonzero(taken & ~same)
            left, low, high, at = left[on], low[on], high[on], (at[on] + 1) & (len(self.slots) - 1)
        return out

    def _place(self, number: np.ndarray) -> None:
        at = self._slot(self.low.all[number], self.high.all[number])
        while len(number):
            free = self.slots[at] < 0
            self.slots[at[free]] = number[free]  # of those that want one slot, one gets it
            on = self.slots[at] != number
            number, at = number[on], (at[on] + 1) & (len(self.slots) - 1)

    def numbers(self, data: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """The numbers of the pieces from ``start`` to ``end`` of ``data``, and the pieces
        met for the first time.  No piece holds NUL, 16 bytes follow the last one."""
        length, eight = end - start, np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        low = eight[start] & _KEEP[np.minimum(length, 8)]
        high = eight[start + 8] & _KEEP[np.clip(length - 8, 0, 8)]
        out, known = self._find(low, high), len(self)
        out[length > 16] = -1
        rest = np.flatnonzero(out < 0)
        fresh: dict[bytes, int] = {}
        first = []
        for k, i, j in zip(rest.tolist(), start[rest].tolist(), end[rest].tolist()):
            piece = data[i:j]
            number = self.long.get(piece) if j - i > 16 else None
            if number is None:
                number = fresh.setdefault(piece, known + len(first))
                if number == known + len(first):
                    first.append(k)
            out[k] = number
        if fresh:
            self._add(low[first], high[first], fresh)
        return out, list(fresh)

    def _add(self, low: np.ndarray, high: np.ndarray, fresh: dict[bytes, int]) -> None:
        known = len(self)
        self.low.append(low)
        self.high.append(high)
        self.short.append(np.array([len(p) <= 16 for p in fresh]))
        self.long.update((p, number) for p, number in fresh.items() if len(p) > 16)
        if 2 * len(self) > len(self.slots):
            known, self.slots = 0, np.full(1 << (3 * len(self)).bit_length(), -1, np.int32)
        self._place(known + np.flatnonzero(self.short.all[known:]))


_LETTER, _OTHER, _SEEN, _LATIN, _BLANK, _FEED, _SIGNS = (1 << k for k in range(7))


def _kinds() -> bytes:
    """What a byte is.  _SEEN: it begins a visible character (no lead byte of Unicode's
    white space, C2 and E1 to E3, is among them); _LATIN: the lead byte of U+00C0 to
    U+027F, which are letters but for the two that end in _SIGNS behind C3; _OTHER: an
    ASCII character that is no letter; not NUL."""
    return bytes([
        _LETTER * (65 <= b <= 90 or 97 <= b <= 122) | _OTHER * (1 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 127)
        | _SEEN * (0x21 <= b <= 0x7E or 0xC3 <= b <= 0xE0 or 0xE4 <= b <= 0xF4)
        | _LATIN * (0xC3 <= b <= 0xC9) | _BLANK * (b == 0x20) | _FEED * (b == 0x0A) | _SIGNS * (b in (0x97, 0xB7)) for b in range(256)])


_KINDS = _kinds()


def _cuts(data: bytes) -> np.ndarray:
    """Where a byte-level vocabulary splits whatever stands around: before a blank that a
    visible character follows, behind a Latin letter that another ASCII character
    follows, and behind a line feed between visible characters.  Not all such
    places are found, and none beside a NUL."""
    kind = np.frombuffer(data.translate(_KINDS), np.uint8)
    out, letter = np.zeros(len(kind), bool), kind & _LETTER != 0
    letter[1:] |= (kind[:-1] & _LATIN != 0) & (kind[1:] & _SIGNS == 0)
    seen, feed = kind & _SEEN != 0, kind & _FEED != 0
    out[:-1] = (kind[:-1] & _BLANK != 0) & seen[1:]
    out[1:] |= letter[:-1] & (kind[1:] & _OTHER != 0)
    out[2:] |= (letter | seen & (kind & _OTHER != 0))[:-2] & feed[1:-1] & seen[2:]
    return out


class Tokens:
    """Texts -> ids by the tokenizers library, without special tokens added.

    A byte-level vocabulary splits a text at certain places whatever stands around
    (``_cuts``), so the pieces between them are encoded once and the ids of up to
    ``room`` of them kept.  Texts that hold the string of an added token or NUL,
    and vocabularies of other kinds, go whole."""

    def __init__(self, vocabulary: str, room: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.room = Tokenizer.from_str(vocabulary), room
        rules = json.loads(vocabulary)
        split = rules.get("pre_tokenizer") or {}
        self.by_word = (split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
                        and not any(rules.get(x) for x in ("normalizer", "truncation", "padding")) and not rules["model"].get("dropout"))
        size = self.tokenizer.get_vocab_size()
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])  # Ġ: the blank
        self.apart = [b"\0", *(a["content"].encode() for a in rules.get("added_tokens", []))]
        self._forget()

    def _forget(self) -> None:
        self.known, self.ids, self.start, self.size = _Pieces(), _Column(_U32), _Column(np.int64), _Column(np.int64)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, _U32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> None:
        """A hundred pieces at a time.  Those of a blank and visible characters follow each
        other in one text and are told apart by their blanks."""
        words = [p.decode() for p in pieces]
        led = [len(p) > 1 and p.rfind(b" ") == 0 and _KINDS[p[1]] & _SEEN > 0 for p in pieces]
        plain, odd = list(compress(words, led)), [w for w, x in zip(words, led) if not x]
        found = self.tokenizer.encode_batch_fast(["".join(plain[i:i + 100]) for i in range(0, len(plain), 100)], add_special_tokens=False)
        ids = np.array(list(chain.from_iterable([e.ids for e in found])), _U32)
        sizes = [np.diff(np.append(np.flatnonzero(self.opens[ids]), len(ids)))]
        if len(sizes[0]) != len(plain):
            raise ValueError("the vocabulary does not split before a blank")
        portions = [odd[i:i + 100] for i in range(0, len(odd), 100)]
        found = self.tokenizer.encode_batch(portions, is_pretokenized=True, add_special_tokens=False)
        sizes += [np.bincount(np.array(e.word_ids, np.int64), minlength=len(p)) for e, p in zip(found, portions)]
        sizes = np.concatenate(sizes)
        size, start = np.empty(len(led), np.int64), np.empty(len(led), np.int64)
        order = np.argsort(np.logical_not(led), kind="stable")
        size[order], start[order] = sizes, len(self.ids) + np.cumsum(sizes) - sizes
        self.start.append(start)
        self.size.append(size)
        self.ids.append(np.concatenate([ids, *[np.array(e.ids, _U32) for e in found]]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids (u32) of each text, as bytes."""
        return self.encode_utf8([t.encode() for t in texts])

    def encode_utf8(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > self.room:
            self._forget()
        whole = [not self.by_word or any(a in t for a in self.apart) for t in texts]
        apart = iter(self._whole([t.decode() for t, w in zip(texts, whole) if w]))
        raw = b"\0".join([b"" if w else t for t, w in zip(texts, whole)]) + bytes(17)
        after = np.cumsum([1 if w else 1 + len(t) for t, w in zip(texts, whole)], dtype=np.int64)  # a NUL behind each
        begins = _cuts(raw)
        begins[0] = begins[after] = begins[after - 1] = True
        at = np.flatnonzero(begins)
        is_piece = np.frombuffer(raw, np.uint8)[at[:-1]] != 0
        start, end = at[:-1][is_piece], at[1:][is_piece]
        number, fresh = self.known.numbers(raw, start, end)
        if fresh:
            try:
                self._learn(fresh)
            except Exception:
                self._forget()  # they have numbers, but no ids
                raise
        size = self.size.all.take(number)
        total = np.append(0, np.cumsum(size))
        ids = self.ids.all.take(np.repeat(self.start.all.take(number) - total[:-1], size) + np.arange(int(total[-1])))
        ends = total[np.searchsorted(start, after)].tolist()
        return [next(apart) if w else ids[i:j].tobytes() for w, i, j in zip(whole, [0, *ends], ends)]


_LOADED: dict[str, Tokens] = {}  # a Python worker serves many tasks: the last vocabulary stays, with its words


def _tokens(vocabulary: str) -> Tokens:
    if vocabulary not in _LOADED:
        _LOADED.clear()
        _LOADED[vocabulary] = Tokens(vocabulary)
    return _LOADED[vocabulary]


# ------------------------------------------------------------------ files ---

_SEGMENTS = ("part int, segment int, start bigint, n_ids bigint, open_start bigint, open_end boolean, "
             "doc_ids array<bigint>, sizes array<bigint>, data binary")


class _Writer:
    """The ids of one part, gathered into segments."""

    def __init__(self, part: int):
        self.part, self.segment, self.start = part, 0, 0
        self.open_start = 0  # where the document begins that the segment begins in or with
        self.docs: list[list] = []
        self.raw: list[bytes] = []
        self.held = 0

    def add(self, doc_id, raw: bytes):
        begin, n = self.start + self.held, len(raw) // 4
        while self.held + n >= SEGMENT:
            take = SEGMENT - self.held
            n -= take
            self._put(doc_id, raw[:4 * take], take)
            raw = raw[4 * take:]
            yield self.cut(n > 0)
            self.open_start = begin if n else self.start
        if n:
            self._put(doc_id, raw, n)

    def _put(self, doc_id, raw: bytes, n: int) -> None:
        self.docs.append([doc_id, n])
        self.raw.append(raw)
        self.held += n

    def cut(self, open_end: bool) -> pa.RecordBatch:
        ids, sizes = zip(*self.docs)
        data = encode(np.frombuffer(b"".join(self.raw), _U32))
        row = [(self.part, pa.int32()), (self.segment, pa.int32()), (self.start, pa.int64()), (self.held, pa.int64()),
               (self.open_start, pa.int64()), (open_end, pa.bool_()), (list(ids), pa.list_(pa.int64())),
               (list(sizes), pa.list_(pa.int64())), (data, pa.binary())]
        self.segment, self.start, self.docs, self.raw, self.held = self.segment + 1, self.start + self.held, [], [], 0
        names = ["part", "segment", "start", "n_ids", "open_start", "open_end", "doc_ids", "sizes", "data"]
        return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in row], names=names)


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenize ``docs`` by the vocabulary file (read on the driver, broadcast: its size
    is the file's) and write their ids, each document's followed by ``end_id``, to
    ``folder`` in ascending order of the document id.  A NULL text is empty, a NULL
    id comes first, rows that repeat an id follow each other."""
    with open(vocabulary, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], _U32).tobytes()

    def run(batches):
        tokens, out, doc_ids = _tokens(sent.value), _Writer(TaskContext.get().partitionId()), ()
        for b, texts in by_bytes(batches):
            doc_ids = b.column(0).to_pylist()
            for doc_id, raw in zip(doc_ids, tokens.encode_utf8(texts)):
                yield from out.add(doc_id, raw + end)
        if out.held:
            yield out.cut(False)

    rows = id_text(docs, id_col, text_col).select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    (rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
     .mapInArrow(run, _SEGMENTS).write.parquet(folder))


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    """The table, ``first`` being the place of a part's first id among all."""
    rows = spark.read.schema(_SEGMENTS).parquet(folder)
    parts = rows.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row for each writing task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(F.broadcast(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))), "part")


def _pieces(b: pa.RecordBatch):
    """Per row of segments: its ids and ``(doc_id, start of the document, first, end
    in the segment, whole)`` of each document in it."""
    for r in b.to_pylist():
        ids, at, out = decode(r["data"]), 0, []
        last = len(r["sizes"]) - 1
        for k, (doc_id, n) in enumerate(zip(r["doc_ids"], r["sizes"])):
            begin = r["open_start"] if k == 0 else r["start"] + at
            whole = begin == r["start"] + at and not (k == last and r["open_end"])
            out.append((doc_id, r["first"] + begin, at, at + n, whole))
            at += n
        yield r["first"] + r["start"], ids, out


def crc_of(pieces) -> int:
    """CRC-32 of consecutive pieces given by ``(bytes, CRC-32)``: with A before B of
    n bytes, crc(AB) = crc(B) ^ crc(0^n after crc(A)) ^ crc(0^n)."""
    out = 0
    for n, crc in pieces:
        zeros = bytes(n)
        out = crc ^ zlib.crc32(zeros, out) ^ zlib.crc32(zeros)
    return out


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read from the files:
    the number of ids before it, its own, and the CRC-32 of those as u32."""
    def run(batches):
        for b in batches:
            for base, ids, docs in _pieces(b):
                raw = memoryview(ids.tobytes())
                doc, start, lo, hi, whole = zip(*docs)
                crc = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(lo, hi)]
                n = np.array(hi) - np.array(lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n), pa.array(crc, pa.int64()),
                     pa.array(base + np.array(lo)), pa.array(whole)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "at", "whole"])

    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    found = stored(_segments(spark, folder).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, at bigint, whole boolean"))

    def combine(batches):
        for b in batches:
            crc = [crc_of((4 * p["n_tokens"], p["ids_crc32"]) for p in row) for row in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(crc, pa.int64())], names=columns)

    # a document cut by the end of a segment: its pieces in order
    cut = (found.where(~F.col("whole")).groupBy("start")
           .agg(F.min("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
                F.array_sort(F.collect_list(F.struct("at", "n_tokens", "ids_crc32"))).alias("pieces"))
           .select("doc_id", "start", "n_tokens", "pieces")
           .mapInArrow(combine, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))
    return found.where("whole").select(*columns).unionByName(cut)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, ids array<int>)`` of every document, its end id included."""
    def run(batches):
        for b in batches:
            for base, ids, docs in _pieces(b):
                doc, start, lo, hi, whole = zip(*docs)
                lists = pa.ListArray.from_arrays(pa.array([*lo, hi[-1]], pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), lists, pa.array(base + np.array(lo)), pa.array(whole)],
                    names=["doc_id", "start", "ids", "at", "whole"])

    found = stored(_segments(spark, folder).mapInArrow(run, "doc_id bigint, start bigint, ids array<int>, at bigint, whole boolean"))
    cut = found.where(~F.col("whole")).groupBy("start").agg(
        F.min("doc_id").alias("doc_id"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda p: p["ids"])).alias("ids"))
    return found.where("whole").select("doc_id", "start", "ids").unionByName(cut.select("doc_id", "start", "ids"))


def read_range(spark: SparkSession, folder: str, lo: int, hi: int) -> DataFrame:
    """``(start, ids array<int>)``: ids ``lo`` to ``hi`` of all, in one row for each
    segment that holds some; only checkpointed stretches around them are decoded."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                base = r["first"] + r["start"]
                ids = decode(r["data"], max(0, lo - base), hi - base)
                yield pa.RecordBatch.from_arrays([pa.array([max(lo, base)], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))],
                                                 names=["start", "ids"])

    begin = F.col("first") + F.col("start")
    some = _segments(spark, folder).where((begin < hi) & (begin + F.col("n_ids") > lo))
    return some.select("first", "start", "data").mapInArrow(run, "start bigint, ids array<int>")
