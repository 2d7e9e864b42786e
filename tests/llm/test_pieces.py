import os
import random

import pytest

from tessera.llm import pieces as P
from tessera.llm.queries import PIECES

from .helpers import clash, frame

pytestmark = pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary file")
TEXTS = ["", "hello world", "  two  blanks ", "▁", "a▁ b", "line\nline\ttab", "日本語 🙂 \u0000", "Étranger naïve ß", " ", "퟿￿", "x" * 3000,
         "the the the", "<s> </s> <unk> <0x41>"]


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary.read(PIECES)


@pytest.fixture(scope="module")
def automaton(vocabulary):
    return P.Automaton(vocabulary)


def brute(v, text):
    """Plain Viterbi over all substrings of the marked text; ties to the longer last piece."""
    if not text:
        return []
    s = P.MARK + text.replace(P.MARK, "\ud800").replace(" ", P.MARK)
    ids = {p: i for i, (p, t) in enumerate(zip(v.pieces, v.types)) if t == P.NORMAL}
    bytes_ = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(v.pieces, v.types)) if t == P.BYTE}
    unknown = min(v.scores[i] for i in ids.values()) - P.UNKNOWN_PENALTY
    most = max(map(len, ids))
    # words apart, as a piece never crosses from a word to the next
    cuts = [i for i in range(len(s)) if i == 0 or s[i] == P.MARK != s[i - 1]] + [len(s)]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        w = s[a:b]
        best, took = [0.0] + [None] * len(w), [None] * (len(w) + 1)
        for k in range(1, len(w) + 1):
            best[k], took[k] = best[k - 1] + unknown, (1, None)
            for n in range(min(most, k), 0, -1):
                i = ids.get(w[k - n:k])
                if i is not None and best[k - n] + v.scores[i] > best[k]:
                    best[k], took[k] = best[k - n] + v.scores[i], (n, i)
        back, k = [], len(w)
        while k:
            n, i = took[k]
            back.append([i] if i is not None else [bytes_[x] for x in w[k - 1].replace("\ud800", P.MARK).encode()])
            k -= n
        out += [x for part in back[::-1] for x in part]
    return out


def encode(automaton, texts, room=300_000):
    encoder = P.Encoder(automaton, room)
    out = []
    for at in range(0, len(texts), 7):
        size, ids = encoder.encode([t.encode() for t in texts[at:at + 7]])
        at = 0
        for n in size.tolist():
            out.append(ids[at:at + n].tolist())
            at += n
    return out


def test_brute_force_and_round_trip(vocabulary, automaton):
    rng = random.Random(10)
    alphabet = "abcdeéü  ▁日\n.,THE"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(150)]
    back = P.decoder(vocabulary)
    for room in (300_000, 20):  # with and without forgetting
        for t, ids in zip(texts, encode(automaton, texts, room)):
            assert ids == brute(vocabulary, t), t
            assert back(ids).decode() == t


def test_library_decodes_the_same(vocabulary, automaton):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=PIECES)
    texts = ["hello world", "naïve café 日本", "a b  c"]
    assert [sp.decode(ids) for ids in encode(automaton, texts)] == texts


def test_automaton_lists_every_piece_that_ends_here(vocabulary, automaton):
    import numpy as np

    word = "▁the"
    state = np.zeros(1, np.int64)
    for ch in word:
        at = int(np.searchsorted(automaton.chars, ord(ch)))
        state = automaton.step(state, np.array([at]))
    u, found = int(state[0]), []
    while u:
        if automaton.piece[u] >= 0:
            found.append(vocabulary.pieces[automaton.piece[u]])
        u = int(automaton.out[u])
    assert found == [word[i:] for i in range(4) if word[i:] in vocabulary.pieces]


def test_documents(spark):
    rows = list(enumerate(TEXTS)) + [(None, "a b"), (1, "hello world"), (99, None)]
    out = P.encode_and_check(frame(spark, rows), PIECES).collect()
    assert len(out) == len(rows) and all(r["exact"] and r["n_tokens"] == len(r["ids"]) for r in out)
    df = P.encode(frame(spark, rows), PIECES)
    texts = df.select("doc_id", P.decode(df["ids"], spark, PIECES).alias("t")).collect()
    assert sorted((str(r[0]), r[1]) for r in texts) == sorted((str(i), t or "") for i, t in rows)
    schema = "doc_id bigint, text string, ids int, exact string"
    assert P.encode_and_check(spark.createDataFrame([], schema), PIECES).count() == 0


def test_words_are_told_apart_by_their_characters(vocabulary, automaton):
    s, t = clash()
    for a, b in ((s, t), (t, s)):
        text = f"{a} {b} {a}"
        assert encode(automaton, [text]) == [brute(vocabulary, text)]


def test_inner_marks_are_refused():
    with pytest.raises(ValueError):
        P.Automaton(P.Vocabulary(("a▁b",), (0.0,), (P.NORMAL,)))
