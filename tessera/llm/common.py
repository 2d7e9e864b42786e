"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

U64 = np.uint64


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id bigint, text string)``; a NULL text counts as empty."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table to the shared checkpoint folder and read
    again: like a checkpoint, for large rows of numbers that Parquet packs."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A string column of a batch as UTF-8 bytes, without decoding it.
    ``bytes.split()`` cuts these at ``[\\x20\\x09-\\x0D]`` exactly."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


def packed(texts: DataFrame) -> DataFrame:
    """``(doc_id, data)`` with each text as zstd-compressed UTF-8: a third less to
    shuffle than the exchange's own compression leaves, for texts that are
    needed in Python anyway.  ``unpacked`` is the inverse."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in in_pieces(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([pack(t) for t in utf8(b)], pa.binary())], names=["doc_id", "data"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id bigint, data binary")


def unpacked(batch: pa.RecordBatch | pa.Table) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(x) for x in batch.column(batch.schema.get_field_index("data")).to_pylist()]


def in_pieces(batches, rows: int = 1000):
    """Batches of at most ``rows`` rows, so that a worker holds few texts at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def by_bytes(batches, most: int = 1 << 20, name: str = "text"):
    """``(batch, texts)`` slices of about ``most`` bytes of UTF-8 text, at least one
    row each: what a worker holds is bounded by bytes, not by rows."""
    for b in in_pieces(batches):
        texts = utf8(b, name)
        at = held = 0
        for i, t in enumerate(texts):
            if held and held + len(t) > most:
                yield b.slice(at, i - at), texts[at:i]
                at, held = i, 0
            held += len(t)
        if at < len(texts):
            yield b.slice(at), texts[at:]


BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


class Powers:
    """Powers of ``BASE`` and of its inverse modulo 2^64, as far as needed."""

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(1, U64)

    def reach(self, n: int) -> None:
        if n > len(self.power):
            n = max(n, 2 * len(self.power))
            self.power = np.cumprod(np.append(U64(1), np.full(n - 1, BASE, U64)))
            self.inverse = np.cumprod(np.append(U64(1), np.full(n - 1, pow(BASE, -1, 2**64), U64)))

    def prefix(self, digits: np.ndarray) -> np.ndarray:
        """P[k] = sum of d[j] BASE^j over j < k; the piece [s, e) then hashes to
        (P[e] - P[s]) BASE^-s = d[s] + d[s+1] BASE + ..., wherever it stands."""
        self.reach(len(digits) + 1)
        out = np.zeros(len(digits) + 1, U64)
        np.cumsum(digits * self.power[:len(digits)], out=out[1:])
        return out


class WordHashes(dict):
    """Word (UTF-8) -> XXH64.  Words recur, so hashes are kept until there are ``room``."""

    def __init__(self, room: int = 500_000):
        super().__init__()
        self.room = room

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.room:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64): spreads every input bit over the output."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def long_column(x: np.ndarray) -> pa.Array:
    """uint64 values as the bigint with the same bits."""
    return pa.array(np.ascontiguousarray(x, U64).view(np.int64))
