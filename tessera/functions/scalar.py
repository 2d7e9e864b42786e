"""Column helpers: strings, dates, math, arrays, maps and null handling.

All helpers return built-in Catalyst expressions, so they stay inside whole
stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed values that must equal the reference's behaviour.
HELLO_PREFIX = "hello , "          # STR-01 prefix, including the space before the comma
NULL_MARKERS = ("null", "\\n")      # NUL-01 sentinels after lower(): `null` (any case) and `\N`


# ---------------------------------------------------------------- strings ---

def say_hello(name) -> Column:
    """STR-01: ``'hello , ' || name``; NULL stays NULL."""
    return F.concat(F.lit(HELLO_PREFIX), as_col(name))


def non_blank(c) -> Column:
    """FLT-03: present and non-empty."""
    c = as_col(c)
    return c.isNotNull() & (F.length(c) > 0)


def clean_sentinel(c) -> Column:
    """NUL-01: the text markers ``null`` (any case) and ``\\N`` become NULL."""
    c = as_col(c)
    return F.when(F.lower(c).isin(*NULL_MARKERS), F.lit(None).cast("string")).otherwise(c)


def edge_label(uid, wifi) -> Column:
    """STR-06: ``uid->wifi``."""
    return F.concat_ws("->", as_col(uid).cast("string"), as_col(wifi))


def phrase_tokens(features) -> Column:
    """STR-08: inner spaces of each phrase become ``_``; phrases joined by a space."""
    return F.array_join(F.transform(as_col(features), lambda x: F.replace(x, F.lit(" "), F.lit("_"))), " ")


def jvm_split(c, sep: str = " ", regex: bool = False) -> Column:
    """GEN-04/Q13: split with the JVM ``String.split`` rule.

    Spark's ``split`` keeps trailing empty strings; the JVM drops them.  So
    trailing separators are cut first; an empty input gives one empty word and
    an input made only of separators gives none.  Interior empties stay.
    """
    c = as_col(c)
    pattern = sep if regex else _regex_escape(sep)
    stripped = F.regexp_replace(c, f"(?:{pattern})+\\z", "")
    return (F.when(c.isNull(), F.lit(None))
            .when(c == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, pattern, -1)))


def _regex_escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch)
    return "".join(out)


# ------------------------------------------------------------------ dates ---

def epoch_ms_to_day(ms, fmt: str = "yyyyMMdd") -> Column:
    """DAT-01: epoch milliseconds (string or number) -> day text in the session
    time zone; unparsable input gives NULL."""
    secs = F.floor(as_col(ms).try_cast("bigint") / 1000)
    return F.from_unixtime(secs, fmt)


def date_to_int(d) -> Column:
    """DAT-02: date -> yyyyMMdd int."""
    return F.date_format(as_col(d), "yyyyMMdd").cast("int")


def int_to_date(i) -> Column:
    """DAT-02: yyyyMMdd int -> date."""
    return F.to_date(as_col(i).cast("string"), "yyyyMMdd")


def day_sequence_desc(day, n) -> Column:
    """GEN-09: the N+1 days from ``day`` back to ``day - n`` (newest first) as
    ``yyyyMMdd`` strings.  ``day`` is a ``yyyyMMdd`` string or a date."""
    d = as_col(day)
    d = F.when(d.cast("string").rlike("^[0-9]{8}$"), F.to_date(d.cast("string"), "yyyyMMdd")).otherwise(d.cast("date"))
    n = as_col(n)
    seq = F.sequence(d, F.date_sub(d, n), F.expr("INTERVAL -1 DAY"))
    return F.transform(seq, lambda x: F.date_format(x, "yyyyMMdd"))


# ------------------------------------------------------------------- math ---

def safe_div(x, numerator: int = 100, default: int = 0) -> Column:
    """MTH-01: integer ``numerator / x`` truncated toward zero; ``default`` at x = 0."""
    x = as_col(x)
    return (F.when(x == 0, F.lit(default).cast("bigint"))
            .otherwise((F.lit(numerator) / x).cast("bigint")))


def clip_upper(c, bound) -> Column:
    """MTH-03: ``min(c, bound)`` keeping NULL as NULL (``least`` alone would
    return the bound)."""
    c = as_col(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(c, as_col(bound)))


def name_id(name) -> Column:
    """MTH-04: name-based 64-bit id = most significant 64 bits of the MD5
    (version 3) UUID of the UTF-8 bytes, as a signed bigint."""
    h = F.md5(as_col(name))
    hex16 = F.concat(F.substring(h, 1, 12), F.lit("3"), F.substring(h, 14, 3))
    return F.conv(hex16, 16, -10).cast("bigint")


# ----------------------------------------------------------------- arrays ---

def list_contains(lst, s) -> Column:
    """ARR-01: NULL when the list or the probe is NULL, else TRUE/FALSE
    (a NULL element never makes the answer NULL, unlike array_contains)."""
    lst, s = as_col(lst), as_col(s)
    return (F.when(lst.isNull() | s.isNull(), F.lit(None).cast("boolean"))
            .otherwise(F.exists(lst, lambda x: x.eqNullSafe(s))))


def word_count(text, sep: str = " ") -> Column:
    """ARR-03: number of pieces of a single-space split, trailing empties kept."""
    return F.size(F.split(as_col(text), _regex_escape(sep), -1))


# ------------------------------------------------------------------- maps ---

def code_map(c, mapping: dict) -> Column:
    """MAP-03: look ``c`` up in a small literal map (e.g. high/medium/low -> 0/1/2)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*kv), as_col(c))


def map_to_text(m, sep: str = ",", kv_sep: str = "=") -> Column:
    """Render a map as ``k=v`` pairs sorted by key (stable text for comparisons)."""
    m = as_col(m)
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"].cast("string"), F.lit(kv_sep),
                                                                F.coalesce(e["value"].cast("string"), F.lit("null")))), sep)
