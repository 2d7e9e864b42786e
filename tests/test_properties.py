"""Property tests: column expressions against small pure-Python models of
their definitions, on many random inputs at once."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from tessera.functions import geohash, jvm_split
from tessera.functions.text import index_tokens

ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def bisect_geohash(lat, lon, n):
    """Definition: alternate longitude/latitude bisection, longitude first,
    value >= mid gives 1; 5 bits per base-32 character."""
    lo = [-180.0, -90.0]
    hi = [180.0, 90.0]
    bits = []
    for i in range(5 * n):
        axis = i % 2
        v = lon if axis == 0 else lat
        mid = (lo[axis] + hi[axis]) / 2
        if v >= mid:
            bits.append(1)
            lo[axis] = mid
        else:
            bits.append(0)
            hi[axis] = mid
    return "".join(ALPHABET[int("".join(map(str, bits[k:k + 5])), 2)] for k in range(0, 5 * n, 5))


def test_geohash_matches_bisection(spark):
    rnd = random.Random(11)
    pts = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180), rnd.randint(1, 12)) for _ in range(400)]
    # exact cell edges and values just around them
    for k in range(40):
        e_lon = -180 + rnd.randint(0, 2 ** 15) * 360 / 2 ** 15
        e_lat = -90 + rnd.randint(0, 2 ** 15) * 180 / 2 ** 15
        for d in (0.0, 1e-12, -1e-12, 5e-324, -5e-324):
            pts.append((min(90.0, max(-90.0, e_lat + d)), min(180.0, max(-180.0, e_lon + d)), 12))
    df = spark.createDataFrame(pts, "lat double, lon double, n int")
    got = [r[0] for r in df.select(geohash("lat", "lon", F.col("n"))).collect()]
    assert got == [bisect_geohash(a, b, n) for a, b, n in pts]


def java_split(s, sep=" "):
    """Definition of String.split(literal): keep interior empties, drop
    trailing empties; the empty string gives one empty string."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_jvm_split_matches_definition(spark):
    rnd = random.Random(5)
    lines = ["".join(rnd.choice("ab  ") for _ in range(rnd.randint(0, 8))) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in lines], "s string")
    got = [r[0] for r in df.select(jvm_split("s", " ")).collect()]
    assert got == [java_split(x) for x in lines]


def per_token_model(text):
    """Definition of the positional tokeniser: lower-case, split on
    whitespace, skip leading non-word characters, keep the first run of a-z,
    drop tokens without one."""
    out = []
    for tok in text.lower().split():
        m = re.match(r"[^\w]*([a-z]+)", tok)
        if m:
            out.append(m.group(1))
    return out


def test_tokeniser_matches_per_token_model(spark):
    rnd = random.Random(3)
    pieces = ["the", "Hard", "part", "file-pointer", "(int)", "\"quoted\"", "9lives", "_x", "é", "éa", "naïve",
              "a.b", "--", "x1y", "ÉCOLE", "über", "…dots", "tab\tsep", "line\nbreak", "nbsp x", "«mot»"]
    texts = [" ".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12))) for _ in range(200)]
    texts = [t for t in texts if all(unicodedata.category(c) != "Zl" for c in t)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(index_tokens("t")).collect()]
    assert got == [per_token_model(t) for t in texts]
