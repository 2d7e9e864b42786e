"""SentencePiece encoding and decoding.

The pieces of a vocabulary file form an Aho-Corasick automaton.  One pass over
a text drives it; at every position the output links list the pieces that end
there, and each relaxes the best score at that position (Viterbi).  No piece
holds a word mark inside, so the best path of a text is that of its words, each
with its leading blanks; equal words are encoded once, and the new words of a
batch advance through the automaton together, one position at a time, in numpy.

The vocabulary file is read on the driver and the automaton (a few MB, its size
is the file's) is broadcast; documents are encoded where they lie.

Rules: as in the file's normaliser (identity), one blank is put before a text
and U+0020 becomes the mark U+2581.  A character without a piece costs the
least score minus 10 and becomes its UTF-8 byte pieces.  A literal U+2581 is
spelt in byte pieces too, so decoding returns every text exactly.  Ties go to
the longer last piece.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, id_text

MARK = "▁"
_LITERAL = "\ud800"  # stands for a literal mark while encoding: a lone surrogate, which no text holds
UNKNOWN_PENALTY = 10.0
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the file format


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    types: tuple[int, ...]

    @staticmethod
    def read(path: str) -> "Vocabulary":
        """From a SentencePiece model file."""
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        kinds = [BYTE if sp.is_byte(i) else CONTROL if sp.is_control(i) else UNKNOWN if sp.is_unknown(i) else NORMAL
                 for i in ids]
        return Vocabulary(tuple(map(sp.id_to_piece, ids)), tuple(map(sp.get_score, ids)), tuple(kinds))


class Automaton:
    """Aho-Corasick automaton as arrays.  Node 0 is the root; the edge of node
    u by character class c is found under ``u * classes + c`` in sorted keys."""

    def __init__(self, v: Vocabulary):
        words = [(p, i) for i, (p, t) in enumerate(zip(v.pieces, v.types)) if t == NORMAL and p]
        inner = [p for p, _ in words if MARK in p.lstrip(MARK)]
        if inner:
            raise ValueError(f"pieces with an inner word mark: {inner[:3]}")
        chars = sorted({c for p, _ in words for c in p})
        self.chars = np.array([ord(c) for c in chars], np.int64)
        classes = {c: i for i, c in enumerate(chars)}
        self.classes = len(chars)
        edges: list[dict[int, int]] = [{}]
        depth, piece = [0], [-1]
        for p, i in words:
            u = 0
            for c in p:
                k = classes[c]
                if k not in edges[u]:
                    edges[u][k] = len(edges)
                    edges.append({})
                    depth.append(depth[u] + 1)
                    piece.append(-1)
                u = edges[u][k]
            piece[u] = i
        fail, out = [0] * len(edges), [0] * len(edges)
        queue = list(edges[0].values())
        for u in queue:  # by depth
            for k, w in edges[u].items():
                f = fail[u]
                while f and k not in edges[f]:
                    f = fail[f]
                fail[w] = edges[f].get(k, 0)
                out[w] = fail[w] if piece[fail[w]] >= 0 else out[fail[w]]
                queue.append(w)
        keys = sorted((u * self.classes + k, w) for u, e in enumerate(edges) for k, w in e.items())
        self.keys, self.next = (np.array(x, np.int64) for x in zip(*keys))
        self.fail, self.out = np.array(fail), np.array(out)
        self.depth, self.piece = np.array(depth), np.array(piece)
        self.score = np.array(v.scores, np.float64)
        self.length = [len(p) for p in v.pieces]
        self.bytes = np.full(256, -1, np.int64)
        for i, (p, t) in enumerate(zip(v.pieces, v.types)):
            if t == BYTE:
                self.bytes[int(p[3:5], 16)] = i
        if (self.bytes < 0).any():
            raise ValueError("the vocabulary has no byte pieces")
        self.unknown = float(self.score[[i for _, i in words]].min()) - UNKNOWN_PENALTY

    def step(self, state: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """The states after reading one character class each (-1: in no piece)."""
        state = np.where(cls < 0, 0, state)
        todo = np.flatnonzero(cls >= 0)
        while len(todo):
            want = state[todo] * self.classes + cls[todo]
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            hit = self.keys[at] == want
            state[todo[hit]] = self.next[at[hit]]
            todo = todo[~hit]
            todo = todo[state[todo] > 0]  # the root keeps what it cannot read
            state[todo] = self.fail[state[todo]]
            # a state that fell back to the root tries its edge there next time round
        return state

    def encode(self, words: list[str]) -> list[bytes]:
        """Piece ids (int32, as bytes) of every non-empty word by Viterbi, all
        words abreast."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-size, kind="stable")
        size = size[order]
        most, n = int(size[0]) if len(words) else 0, len(words)
        start = np.cumsum(size) - size
        codes = np.frombuffer("".join(words[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.chars, codes), self.classes - 1)
        cls = np.where(self.chars[at] == codes, at, -1)
        # best[start + word + k]: score of the best path over the word's first k characters
        base = start + np.arange(n)
        best = np.full(len(codes) + n, -np.inf)
        took = np.zeros(len(best), np.int64)  # node of the last piece of that path; 0: an unknown character
        best[base] = 0.0
        state = np.zeros(n, np.int64)
        alive = n
        for k in range(1, most + 1):
            alive = int(np.searchsorted(-size[:alive], -k, "right"))
            here = base[:alive] + k
            state = self.step(state[:alive], cls[start[:alive] + (k - 1)])
            top, by = best[here - 1] + self.unknown, np.zeros(alive, np.int64)
            node = np.where(self.piece[state] >= 0, state, self.out[state])
            rows = np.flatnonzero(node)
            while len(rows):  # along the output links: ever shorter pieces
                u = node[rows]
                s = best[here[rows] - self.depth[u]] + self.score[self.piece[u]]
                better = s > top[rows]
                top[rows[better]], by[rows[better]] = s[better], u[better]
                node[rows] = self.out[u]
                rows = rows[self.out[u] > 0]
            best[here], took[here] = top, by
        return self._trace(words, order, base, size, took)

    def _trace(self, words, order, base, size, took) -> list[bytes]:
        """Follow the best paths back from the words' ends, all words abreast."""
        rows, at = np.arange(len(order)), base + size
        passed, found = [], []
        while len(rows):
            u = took[at]
            passed.append(rows)
            found.append(np.where(u > 0, self.piece[u], -1))
            at = at - np.maximum(self.depth[u], 1)
            more = at > base[rows]
            rows, at = rows[more], at[more]
        count = np.zeros(len(order), np.int64)
        for r in passed:
            count[r] += 1
        last = np.cumsum(count)
        flat = np.empty(int(last[-1]) if len(last) else 0, np.int32)
        for k, (r, ids) in enumerate(zip(passed, found)):
            flat[last[r] - 1 - k] = ids
        raw, out = flat.tobytes(), [b""] * len(words)
        for i, e, n in zip(order.tolist(), last.tolist(), count.tolist()):
            out[i] = raw[4 * (e - n):4 * e]
        where = np.unique(np.searchsorted(last, np.flatnonzero(flat < 0), "right"))
        for r in where.tolist():  # words with characters that no piece covers
            i = int(order[r])
            out[i] = self._spelt(words[i], flat[last[r] - count[r]:last[r]].tolist())
        return out

    def _spelt(self, word: str, ids: list[int]) -> bytes:
        """Ids with each -1 replaced by the byte pieces of its character."""
        out, k = [], 0
        for x in ids:
            if x >= 0:
                out.append(x)
                k += self.length[x]
            else:
                ch = MARK if word[k] == _LITERAL else word[k]
                out += self.bytes[list(ch.encode())].tolist()
                k += 1
        return np.array(out, np.int32).tobytes()


def marked(word: bytes) -> str:
    """A word with its leading blanks as the automaton reads it."""
    return word.decode().replace(MARK, _LITERAL).replace(" ", MARK)


class Encoder:
    """Texts -> ids.  The ids of up to ``room`` words are kept, by the words
    themselves, from one call to the next."""

    def __init__(self, automaton: Automaton, room: int = 300_000):
        self.automaton, self.room = automaton, room
        self.words = re.compile(rb" +[^ ]*|[^ ]+").findall  # each with its leading blanks
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.start, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _learn(self, words: list[bytes]) -> None:
        ids = self.automaton.encode([marked(w) for w in words])
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.start = np.append(self.start, len(self.flat) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.flat = np.append(self.flat, np.frombuffer(b"".join(ids), np.int32))
        self.known.update(zip(words, range(len(self.known), len(self.size))))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(number of ids of each text, all ids)``; texts are UTF-8."""
        each = [self.words(b" " + t) if t else [] for t in texts]
        words = list(chain.from_iterable(each))
        if len(self.known) > self.room:
            self._forget()
        self._learn(list(set(words).difference(self.known)))
        place = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        size = self.size[place]
        total = np.append(0, np.cumsum(size))
        ids = self.flat[np.repeat(self.start[place] - total[:-1], size) + np.arange(int(total[-1]))]
        ends = np.cumsum(np.fromiter(map(len, each), np.int64, len(each)))
        return np.diff(total[ends], prepend=0), ids


def decoder(v: Vocabulary):
    """A function ids -> UTF-8 text, the inverse of encoding."""
    raw = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t in (CONTROL, UNKNOWN) else p.replace(MARK, " ").encode()
           for p, t in zip(v.pieces, v.types)]

    def decode(ids) -> bytes:
        return b"".join([raw[i] for i in ids]).removeprefix(b" ")  # the blank that encoding put before the text

    return decode


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``(doc_id, n_tokens, ids array<int>)``.  NULL and
    empty texts have no ids; a NULL id stays NULL; repeated rows repeat."""
    return _encode(docs, model_path, id_col, text_col, False)


def encode_and_check(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, with ``exact``: whether decoding the ids gave the text."""
    return _encode(docs, model_path, id_col, text_col, True)


def _encode(docs: DataFrame, model_path: str, id_col: str, text_col: str, check: bool) -> DataFrame:
    vocabulary = Vocabulary.read(model_path)
    sent = docs.sparkSession.sparkContext.broadcast((Automaton(vocabulary), vocabulary if check else None))

    def run(batches):
        automaton, back = sent.value
        encoder, to_text = Encoder(automaton), back and decoder(back)
        for b, texts in by_bytes(batches):
            size, ids = encoder.encode(texts)
            ends = np.cumsum(size)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids))
            columns = [b.column(0), pa.array(size), lists]
            if check:
                columns.append(pa.array([to_text(x.tolist()) == t for x, t in zip(np.split(ids, ends[:-1]), texts)]))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "exact"][:len(columns)])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids array<int>" + ", exact boolean" * check)


def decode(ids: Column, spark, model_path: str) -> Column:
    """``array<int>`` of ids -> text; NULL gives NULL, unknown and control ids
    nothing, byte pieces that are no UTF-8 the replacement character."""
    sent = spark.sparkContext.broadcast(Vocabulary.read(model_path))

    @F.pandas_udf("string")
    def decoded(column):
        to_text = decoder(sent.value)
        return column.map(lambda x: None if x is None else to_text(x).decode("utf-8", "replace"))

    return decoded(ids)
