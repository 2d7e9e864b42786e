"""Secret scan: fixed patterns plus sliding-window entropy.

A document is scanned where it lies (no shuffle).  Candidate strings are the
maximal runs of a character class; a window slides over each and its Shannon
entropy is kept up to date from two count changes a step.  Windows at or
above the class's threshold merge into spans.  A window counts only if it often
changes between lower case, upper case and digits and holds few of the marks
``/ _ -`` that join words: paths, slugs and identifiers have much entropy, too,
but hardly ever all that.  The allow list suppresses either whole spans or only
the windows it overlaps, see ``Scan.allow_whole``.  A text of n characters takes O(n log n) steps.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from dataclasses import dataclass, field
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import by_bytes, id_text

#: Fixed patterns, and the least length of assign's second group and of access.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, so the same spans as those of 32+ among [0-9a-f]+
LEAST = {"assign": 8, "access": 16}
ORDER = {"assign": 0, "access": 1, "hex": 2, "entropy_hex": 3, "entropy_base64": 4,
         "entropy_hex_short": 5, "entropy_base64_short": 6}
#: changes of case for each character that a window without digits must have; words joined by capitals have fewer
NO_DIGIT = 0.55
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")


@dataclass(frozen=True)
class CharClass:
    """Candidates are runs of ``chars`` at least ``window`` long.  A window must hold a
    letter, at most ``marks`` of ``/ _ -``, and change at least ``changes`` times between
    lower case, upper case and digits, marks left out (``NO_DIGIT`` a
    character without a digit)."""
    name: str
    chars: str
    window: int
    threshold: float
    marks: int = 64
    changes: int = 1


@dataclass(frozen=True)
class Scan:
    classes: tuple[CharClass, ...] = (
        CharClass("entropy_hex", "0-9A-Fa-f", 32, 3.2),
        CharClass("entropy_base64", "A-Za-z0-9+/_=-", 32, 4.3, marks=4, changes=6),
        # tokens of 20 to 31 characters; 20 have log2 20 = 4.32 bits at most
        CharClass("entropy_hex_short", "0-9A-Fa-f", 20, 3.0),
        CharClass("entropy_base64_short", "A-Za-z0-9+/_=-", 20, 3.7, marks=3, changes=4),
    )
    #: strings that are no secrets (case-insensitive)
    allow: tuple[str, ...] = field(default=(
        "example", "placeholder", "changeme", "dummy", "redacted", "abcdefghij", "0123456789", r"(.)\1{7}"))
    #: False: only the windows that overlap one of them are suppressed, before windows
    #: merge, so that a secret in the same run stays.  True: a span is suppressed
    #: whole if one is found in it
    allow_whole: bool = False


def sliding_entropy(s: str, window: int) -> list[float]:
    """Entropy in bits of every window of ``s``.  With counts c that sum to w,
    H = log2 w - (sum c log2 c) / w; a step changes two counts."""
    if len(s) < window:
        return []
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    top, out = math.log2(window), []
    for i, ch in enumerate(s):
        if i >= window:
            old = s[i - window]
            c = counts[old]
            total += term[c - 1] - term[c]
            counts[old] = c - 1
        c = counts.get(ch, 0)
        total += term[c + 1] - term[c]
        counts[ch] = c + 1
        if i >= window - 1:
            out.append(top - total / window)
    return out


def _kinds(run: str):
    """Per character, as 0 or 1: a letter, a digit, a mark, and of another kind (lower
    case, upper case, digit) than the character before it that has one."""
    kind = ["d" if x.isdigit() else "l" if x.islower() else "u" if x.isupper() else "" for x in run]
    change, last = [], ""
    for k in kind:
        change.append(int(k != "" != last and k != last))
        last = k or last
    return [int(k in ("l", "u")) for k in kind], [int(k == "d") for k in kind], [int(x in "/_-") for x in run], change


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], ORDER[s[0]]))


class Scanner:
    """The compiled form of a ``Scan``."""

    def __init__(self, scan: Scan):
        self.classes = [(c, re.compile(f"[{c.chars}]{{{c.window},}}")) for c in scan.classes]
        self.allow = [re.compile(a, re.IGNORECASE) for a in scan.allow]
        self.allow_whole = scan.allow_whole

    @staticmethod
    def _fits(c: CharClass, letters: int, digits: int, marks: int, changes: int, first: int) -> bool:
        changes -= first
        return letters > 0 and (digits > 0 or changes >= NO_DIGIT * c.window) and marks <= c.marks and changes >= c.changes

    def _windows(self, text: str, c: CharClass, lo: int, hi: int) -> list[int]:
        """Starts of the windows of the run ``[lo, hi)`` that count."""
        run = text[lo:hi]
        high = [lo + i for i, h in enumerate(sliding_entropy(run, c.window)) if h >= c.threshold]
        if high:
            counts = [[0, *accumulate(x)] for x in _kinds(run)]
            ends = [(i - lo, i - lo + c.window) for i in high]
            high = [i for i, (a, b) in zip(high, ends) if self._fits(c, *(x[b] - x[a] for x in counts), counts[3][a + 1] - counts[3][a])]
        if self.allow_whole or not high:
            return high
        hidden = bytearray(hi - lo)
        for a in self.allow:
            for m in a.finditer(text, lo, hi):
                s, e = max(m.start() - c.window + 1, lo) - lo, m.end() - lo
                hidden[s:e] = b"\1" * (e - s)
        return [i for i in high if not hidden[i - lo]]

    def entropy_spans(self, text: str) -> list[tuple[str, int, int]]:
        out = []
        for c, run in self.classes:
            for m in run.finditer(text):
                start = end = -1
                for i in self._windows(text, c, *m.span()):
                    if i > end >= 0:
                        out.append((c.name, start, end))
                        start = -1
                    start, end = (i if start < 0 else start), i + c.window
                if end >= 0:
                    out.append((c.name, start, end))
        if not self.allow_whole:
            return out
        return [s for s in out if not any(a.search(text, s[1], s[2]) for a in self.allow)]

    def spans(self, text: str) -> tuple[list, list]:
        """``(base, all)``; an entropy span that lies in a base span, or in one
        of an earlier class, says nothing new and is left out."""
        base = base_spans(text)
        found = list(base)
        for _, own in groupby(self.entropy_spans(text), key=lambda s: s[0]):
            # spans of one class lie apart: only earlier ones can hold them
            found.sort(key=lambda s: s[1])
            starts, ends = [s[1] for s in found], [0, *accumulate((s[2] for s in found), max)]
            found += [s for s in own if ends[bisect_right(starts, s[1])] < s[2]]
        return base, sorted(found, key=lambda s: (s[1], ORDER.get(s[0], len(ORDER)), s[2]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scan: Scan | None = None) -> DataFrame:
    """One row per document: ``(doc_id, base, spans)``, arrays of
    ``struct<kind, start, end>`` in code points, end exclusive, ordered by
    start, then kind; ``base`` holds the fixed patterns only.  NULL and empty
    texts have none, a NULL id stays NULL, repeated rows give repeated rows."""
    scan = scan or Scan()
    span = "array<struct<kind:string,start:int,end:int>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        scanner = Scanner(scan)
        for b, texts in by_bytes(batches):
            both = [scanner.spans(t.decode()) for t in texts]
            put = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x[i]] for x in both], arrow) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *put], names=["doc_id", "base", "spans"])

    return id_text(docs, id_col, text_col).mapInArrow(run, f"doc_id bigint, base {span}, spans {span}")
