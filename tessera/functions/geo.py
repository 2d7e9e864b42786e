"""GEO-01/02: geohash as a pure Catalyst expression.

A geohash of n characters is the first 5n bits of a bisection code that
alternates longitude and latitude bits (longitude first); ``value >= mid``
gives a 1.  Since the bisection is sequential, the n-character hash is the
prefix of the 12-character hash, so one 60-bit computation serves every
precision.  The cell index along each axis is found by floor-scaling and then
corrected against the exact cell edges (edges are dyadic, exact in doubles),
which reproduces the bisection exactly even just below an edge.

GEO-03: the alphabet is in ASCII order and a prefix sorts before its
extensions, so ``orderBy`` on the text is the order of the cells.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Base-32 alphabet (no a, i, l, o) and the precision range.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
MIN_PRECISION = 1
MAX_PRECISION = 12
AXIS_BITS = 30  # 60 bits = 12 characters, 30 per axis


def _bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (keeps the expression
    tree small: a lambda variable instead of copies of the subtree)."""
    return F.transform(F.array(value), fn)[0]


def _axis_index(v: Column, lo: float, hi: float, bits: int = AXIS_BITS) -> Column:
    """Largest k with ``lo + k*(hi-lo)/2^bits <= v`` (clamped to the last cell)."""
    n = 1 << bits
    width = (hi - lo) / n
    k0 = F.least(F.greatest(F.floor((v - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(n))).cast("bigint"), F.lit(0)),
                 F.lit(n - 1))

    def down(k):
        return F.when(F.lit(lo) + k.cast("double") * F.lit(width) > v, k - 1).otherwise(k)

    def up(k):
        nxt = F.lit(lo) + (k + 1).cast("double") * F.lit(width)
        return F.least(F.greatest(F.when((nxt <= v) & (k < n - 1), k + 1).otherwise(k), F.lit(0)), F.lit(n - 1))

    return _bind(_bind(k0, down), up)


def _geohash12(lon_idx: Column, lat_idx: Column) -> Column:
    alphabet = F.array(*[F.lit(ch) for ch in GEOHASH_ALPHABET])

    def chars(s):
        out = []
        for c in range(MAX_PRECISION):
            v = None
            for t in range(5):
                g = 5 * c + t
                axis = s["a"] if g % 2 == 0 else s["b"]
                term = F.shiftright(axis, AXIS_BITS - 1 - g // 2).bitwiseAND(F.lit(1)) * (1 << (4 - t))
                v = term if v is None else v + term
            out.append(F.element_at(alphabet, (v + 1).cast("int")))
        return F.concat(*out)

    return _bind(F.struct(lon_idx.alias("a"), lat_idx.alias("b")), chars)


def geohash(lat, lon, precision=12, on_out_of_range: str = "error") -> Column:
    """GEO-01: geohash of (lat, lon) with ``precision`` clamped to 1..12.

    NULL input gives NULL.  Out-of-range coordinates raise an error (the
    reference throws); ``on_out_of_range='null'`` returns NULL instead.
    """
    lat = as_col(lat).cast("double")
    lon = as_col(lon).cast("double")
    p = precision if isinstance(precision, Column) else F.lit(int(precision))
    p = F.least(F.greatest(p.cast("int"), F.lit(MIN_PRECISION)), F.lit(MAX_PRECISION))
    full = _geohash12(_axis_index(lon, -180.0, 180.0), _axis_index(lat, -90.0, 90.0))
    out = F.substr(full, F.lit(1), p)
    bad = (lat < -90) | (lat > 90) | (lon < -180) | (lon > 180) | F.isnan(lat) | F.isnan(lon)
    if on_out_of_range == "null":
        out = F.when(bad, F.lit(None).cast("string")).otherwise(out)
    else:
        out = F.when(bad, F.raise_error(F.lit("geohash: latitude/longitude out of range"))).otherwise(out)
    return F.when(lat.isNull() | lon.isNull(), F.lit(None).cast("string")).otherwise(out)


def geohash_bounds(lat, lon, precision=12) -> dict:
    """GEO-02: cell bounds of the geohash cell as four columns
    (``min_lat, max_lat, min_lon, max_lon``)."""
    lat = as_col(lat).cast("double")
    lon = as_col(lon).cast("double")
    p = precision if isinstance(precision, Column) else F.lit(int(precision))
    p = F.least(F.greatest(p.cast("int"), F.lit(MIN_PRECISION)), F.lit(MAX_PRECISION))
    lon_bits = F.ceil(p * 5 / 2).cast("int")
    lat_bits = F.floor(p * 5 / 2).cast("int")
    lon_k = _axis_index(lon, -180.0, 180.0)
    lat_k = _axis_index(lat, -90.0, 90.0)
    # index at the coarser level = full index >> (30 - bits)
    lon_c = F.floor(lon_k / F.pow(F.lit(2.0), AXIS_BITS - lon_bits))
    lat_c = F.floor(lat_k / F.pow(F.lit(2.0), AXIS_BITS - lat_bits))
    lon_w = F.lit(360.0) / F.pow(F.lit(2.0), lon_bits)
    lat_w = F.lit(180.0) / F.pow(F.lit(2.0), lat_bits)
    return {
        "min_lat": F.lit(-90.0) + lat_c * lat_w,
        "max_lat": F.lit(-90.0) + (lat_c + 1) * lat_w,
        "min_lon": F.lit(-180.0) + lon_c * lon_w,
        "max_lon": F.lit(-180.0) + (lon_c + 1) * lon_w,
    }
