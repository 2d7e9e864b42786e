"""Small inputs shared by the tests: a few texts of every awkward kind."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def components(ids, linked):
    """id -> smallest id reachable, by plain search."""
    ids = list(ids)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def clash(n: int = 1024) -> tuple[str, str]:
    """Two strings (Thue-Morse) that agree in every polynomial hash modulo 2^64 with
    an odd base, from 1024 characters on."""
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s, s.translate(str.maketrans("ab", "ba"))
