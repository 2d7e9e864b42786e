import os
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm import queries as Q
from tessera.llm import rans as R

from .helpers import frame, prose


def ids_of(n, kind, rng):
    if kind == "one":
        return np.full(n, 7, np.uint32)
    if kind == "even":
        return rng.integers(0, 50257, n).astype(np.uint32)
    return np.minimum(rng.zipf(1.3, n), 50256).astype(np.uint32)


@pytest.mark.parametrize("kind", ["one", "even", "skewed"])
@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5000, R.BLOCK - 1, R.BLOCK, R.BLOCK + 1, 3 * R.BLOCK + 17])
def test_round_trip_and_ranges(n, kind):
    rng = np.random.default_rng(n)
    ids = ids_of(n, kind, rng)
    data = R.encode(ids)
    assert np.array_equal(R.decode(data), ids)
    for _ in range(6):
        lo, hi = sorted(rng.integers(0, n + 1, 2).tolist())
        assert np.array_equal(R.decode(data, lo, hi), ids[lo:hi])
    assert np.array_equal(R.decode(data, n - 1 if n else 0, n + 5), ids[-1:])


def test_size_is_near_the_entropy():
    ids = ids_of(1 << 18, "skewed", np.random.default_rng(3))
    share = np.bincount(ids)[np.unique(ids)] / len(ids)
    table = 4 * len(share)
    assert 8 * len(R.encode(ids)) < 1.05 * len(ids) * -(share * np.log2(share)).sum() + 8 * (table + 16 * R.CODERS * 8 * 2)


def test_states_follow_the_definition():
    """The coder against one state at a time in whole numbers."""
    rng = np.random.default_rng(4)
    ids = ids_of(500, "skewed", rng)
    symbols, counts = np.unique(ids, return_counts=True)
    freq = R.scaled(counts)
    assert freq.sum() == 1 << R.SCALE and freq.min() >= 1
    first = np.cumsum(freq) - freq
    place = np.searchsorted(symbols, ids)
    turns = -(-len(ids) // R.CODERS)
    at = np.full(turns * R.CODERS, int(np.argmax(freq)))
    at[:len(ids)] = place
    words, count, states = R._encode_blocks(at.reshape(1, turns, R.CODERS), freq.astype(np.uint64), first.astype(np.uint64))
    xs, out = [1 << 31] * R.CODERS, []
    for t in range(turns - 1, -1, -1):
        now = []
        for c in range(R.CODERS):
            f, lo = int(freq[at[t * R.CODERS + c]]), int(first[at[t * R.CODERS + c]])
            if xs[c] >= f << 63 - R.SCALE:
                now.append(xs[c] & 0xFFFFFFFF)
                xs[c] >>= 32
            xs[c] = (xs[c] // f << R.SCALE) + xs[c] % f + lo
        out = now + out
    assert words.tolist() == out and states[0, 0].tolist() == xs and count.sum() == len(out)


def test_a_damaged_block_is_noticed():
    ids = ids_of(2 * R.BLOCK, "skewed", np.random.default_rng(5))
    data = bytearray(R.encode(ids))
    data[-1000] ^= 1
    with pytest.raises(ValueError):
        R.decode(bytes(data))
    assert np.array_equal(R.decode(bytes(data), 0, R.BLOCK), ids[:R.BLOCK])  # the other one can still be read
    with pytest.raises(ValueError):
        R.decode(b"\0" * 64)


def test_a_range_reads_only_its_stretches(monkeypatch):
    ids = ids_of(3 * R.BLOCK, "even", np.random.default_rng(6))
    data, seen, real = R.encode(ids), [], R._stretch
    monkeypatch.setattr(R, "_stretch", lambda state, *a: seen.append(len(state)) or real(state, *a))
    R.decode(data, R.BLOCK + 10, R.BLOCK + 20)
    assert sum(seen) == 1
    R.decode(data)
    assert sum(seen) == 1 + 3 * R.BLOCK // (R.CODERS * R.EVERY)


def awkward(rng, n):
    alphabet = list(" \n\t  ab'sé日1.,-\x1c\x85  ́l$")
    return (["", "a", " a", "a ", " ", "\n", "  a  b \n c\t d", "<|endoftext|> a <|endoftext|>b", "don't  we'll", "a\r\n b", "x" * 3000, " " * 3000]
            + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))) for _ in range(n)] + [prose(rng, 300)])


def test_words_are_encoded_like_whole_texts():
    with open(Q.BYTES, encoding="utf-8") as f:
        tokens = R.Tokens(f.read(), room=600)
    plain = Tokenizer.from_file(Q.BYTES)
    texts = awkward(random.Random(7), 3000)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        got = [x for i in range(0, len(texts), 200) for x in tokens.encode(texts[i:i + 200])]
        assert [np.frombuffer(x, np.uint32).tolist() for x in got] == want
    assert len(tokens.known) == len(tokens.size) < 4000


def test_a_word_is_encoded_once_whatever_follows_it(monkeypatch):
    with open(Q.BYTES, encoding="utf-8") as f:
        tokens = R.Tokens(f.read())
    rng, learn, seen = random.Random(12), R.Tokens._learn, []
    monkeypatch.setattr(R.Tokens, "_learn", lambda self, pieces: seen.extend(pieces) or learn(self, pieces))
    words = sorted({"".join(rng.choice("abdeghilnorstéü") for _ in range(rng.randrange(3, 9))) for _ in range(500)})
    marks = ["", ",", ".", "!", "?", ";", ":", ")", "...", "'s", "**"]
    texts = [" ".join(w + m for w in words) + ".\n" + "\n".join(w + m for w in words) for m in marks]
    plain = Tokenizer.from_file(Q.BYTES)
    for t in texts:
        assert np.frombuffer(tokens.encode([t])[0], np.uint32).tolist() == plain.encode(t, add_special_tokens=False).ids
    assert len(seen) == len(set(seen)) < 2 * len(words) + 4 * len(marks)  # behind a blank and behind a line feed


def test_pieces_by_whole_texts_of_any_characters():
    alphabet = list("ab's1.,- \n\t é×÷ßÉ") + [" ", " ", "\n", "\r", "\x0b", "\x1c", "\x1f", "\x7f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028",
                                              "\u3000", "\ufeff", "\u200b", "\u0301", "\u0117", "ǃ", "ſ", "ɐ", "²", "½", "ª", "я", "中", "🙂", "\0"]
    with open(Q.BYTES, encoding="utf-8") as f:
        tokens = R.Tokens(f.read())
    plain, rng = Tokenizer.from_file(Q.BYTES), random.Random(13)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) for _ in range(20_000)]
    got = [x for i in range(0, len(texts), 500) for x in tokens.encode(texts[i:i + 500])]
    assert [np.frombuffer(x, np.uint32).tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert tokens.encode([]) == [] and tokens.encode(["", ""]) == [b"", b""]


@pytest.mark.parametrize("clash", [False, True])
def test_numbers_of_pieces(monkeypatch, clash):
    if clash:  # all want the same slot
        monkeypatch.setattr(R._Pieces, "_slot", lambda self, low, high: np.zeros(len(low), np.int64))
    rng, pieces, want = random.Random(14), R._Pieces(), {}
    for _ in range(20):
        some = ["".join(rng.choice("ab") for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 24, 25]))).encode() for _ in range(40 if clash else 400)]
        end = np.cumsum([len(p) for p in some])
        known = len(want)
        number, fresh = pieces.numbers(b"".join(some) + bytes(16), np.append(0, end[:-1]), end)
        assert number.tolist() == [want.setdefault(p, len(want)) for p in some]
        assert fresh == list(want)[known:] and len(pieces) == len(want)


def test_pieces_that_fail_are_not_kept(monkeypatch):
    with open(Q.BYTES, encoding="utf-8") as f:
        tokens = R.Tokens(f.read())
    with pytest.raises(UnicodeDecodeError):
        tokens.encode_utf8([b"some words, \xff\xfe others"])
    assert tokens.encode_utf8([b"some words, others"]) == tokens._whole(["some words, others"])


def test_other_vocabularies_go_whole():
    path = os.path.join(Q.TOKENIZERS, "word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        tokens = R.Tokens(f.read())
    plain = Tokenizer.from_file(path)
    texts = awkward(random.Random(8), 50)
    assert not tokens.by_word
    assert [np.frombuffer(x, np.uint32).tolist() for x in tokens.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def brute(rows, end=2):
    plain, out, at = Tokenizer.from_file(Q.BYTES), [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((i, at, ids))
        at += len(ids)
    return out


@pytest.mark.parametrize("segment", [R.SEGMENT, 1000])
def test_files_by_brute_force(spark, tmp_path, monkeypatch, segment):
    rng = random.Random(9)
    rows = [(3 * i, t) for i, t in enumerate(awkward(rng, 60))] + [(-5, None), (1000, prose(rng, 5000)), (1001, "one"), (None, "no id")]
    rng.shuffle(rows)
    folder = str(tmp_path / "tokens")
    if segment == R.SEGMENT:
        R.write(frame(spark, rows).repartition(5), folder, Q.BYTES, 2)
    else:  # many segments, documents across them: written here, read by Spark
        monkeypatch.setattr(R, "SEGMENT", segment)
        out, batches, plain = R._Writer(0), [], Tokenizer.from_file(Q.BYTES)
        for i, _, ids in brute(rows):
            batches += list(out.add(i, np.array(ids, np.uint32).tobytes()))
        batches += [out.cut(False)] if out.held else []
        import pyarrow as pa
        import pyarrow.parquet as pq
        os.makedirs(folder)
        pq.write_table(pa.Table.from_batches(batches), f"{folder}/part-0.parquet")
        assert len(batches) > 5
    want = brute(rows)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in R.digests(spark, folder).collect())
    assert got == [(at, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, at, ids in want]
    got = sorted((r["start"], r["doc_id"], r["ids"]) for r in R.read(spark, folder).collect())
    assert got == [(at, i, ids) for i, at, ids in want]
    flat = [x for _, _, ids in want for x in ids]
    for lo, hi in ((0, 10), (len(flat) // 2, len(flat) // 2 + 2500), (len(flat) - 1, len(flat) + 9), (len(flat), len(flat) + 1)):
        parts = sorted((r["start"], r["ids"]) for r in R.read_range(spark, folder, lo, hi).collect())
        assert [x for _, ids in parts for x in ids] == flat[lo:hi]


def test_rows_of_one_id_and_empty_tables(spark, tmp_path):
    rows = [(4, "same id"), (4, "same id"), (4, "other text"), (None, None), (None, "b")]
    R.write(frame(spark, rows), str(tmp_path / "a"), Q.BYTES, 2)
    got = sorted(R.digests(spark, str(tmp_path / "a")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, 4, 4, 4]
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:i]) for i in range(5)]
    R.write(frame(spark, []), str(tmp_path / "b"), Q.BYTES, 2)
    assert R.digests(spark, str(tmp_path / "b")).count() == 0 and R.read(spark, str(tmp_path / "b")).count() == 0
    clash = spark.createDataFrame([(1, "a b", 3, "x")], "doc_id bigint, text string, row int, part string")
    R.write(clash, str(tmp_path / "c"), Q.BYTES, 2)
    assert [r["n_tokens"] for r in R.digests(spark, str(tmp_path / "c")).collect()] == [3]


def test_crc_of_pieces():
    data = bytes(random.Random(10).randrange(256) for _ in range(4000))
    cuts = [0, 4, 400, 404, 4000]
    assert R.crc_of((j - i, zlib.crc32(data[i:j])) for i, j in zip(cuts, cuts[1:])) == zlib.crc32(data)
    assert R.crc_of([]) == 0


def test_query_follows_its_contract(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, t, 1) for i, t in enumerate(awkward(rng, 40))] + [(777, None, 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32"))
                 for r in Q.op13_token_files(spark, str(tmp_path)).collect())
    assert got == [(i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, at, ids in brute([r[:2] for r in rows])]
