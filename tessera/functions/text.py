"""Token-level text helpers (STR-05, TXT-01 building blocks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed values.  Whitespace = what a Unicode-aware ``str.split()`` breaks on;
# a "non-word" character is anything but a letter, a digit or ``_``.
WHITESPACE_CLASS = ("[\\t\\n\\x{0B}\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
                    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")
NON_WORD_CLASS = "[^\\p{L}\\p{N}_]"
# STR-05: leading non-word characters, then the first run of a-z.
TOKEN_PATTERN = "^" + NON_WORD_CLASS + "*([a-z]+)"


def whitespace_tokens(text) -> Column:
    """Split on runs of whitespace, dropping empty pieces (``str.split()``)."""
    parts = F.split(as_col(text), WHITESPACE_CLASS + "+", -1)
    return F.filter(parts, lambda x: x != "")


def normalise_token(tok) -> Column:
    """STR-05: ``file-pointer`` -> ``file``; tokens that do not start (after
    punctuation) with a-z give the empty string."""
    return F.regexp_extract(as_col(tok), TOKEN_PATTERN, 1)


# TXT-01 in one regex pass over the whole text: a token starts where the
# previous character is whitespace (or at the start), leading non-word
# characters are skipped, the first run of a-z is captured and the rest of
# the token is consumed.  Tokens without a match produce nothing.  Plain characters
# are tried before the long class of whitespace, and no loop gives anything back.
_WS_BODY = WHITESPACE_CLASS[1:-1]
_VISIBLE = f"[!-~[^{_WS_BODY}]]"
TEXT_TOKEN_PATTERN = (f"(?<!{_VISIBLE})(?:(?![a-z])[^\\p{{L}}\\p{{N}}_{_WS_BODY}])*+([a-z]++){_VISIBLE}*+")


def index_tokens(text) -> Column:
    """TXT-01 on one text: lower, whitespace split, STR-05, drop tokens that
    do not match.  Positions are the indexes in the returned array.  Same
    result as normalising each whitespace token, in a single regex scan."""
    return F.regexp_extract_all(F.lower(as_col(text)), F.lit(TEXT_TOKEN_PATTERN), 1)
