import random

import pytest

from tessera.llm import line_dedup as L

from .helpers import frame, prose

BLANKS = L.BLANKS


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:] if a != b else True


def brute(rows, min_chars):
    lines = [(i, k, x.strip(BLANKS)) for i, t in rows if i is not None for k, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    out = {}
    for i, t in rows:
        gone = [k for j, k, x in lines if j == i and any(
            (d, m) < (i, k) and (x == y or min(len(x), len(y)) >= min_chars and within_one(x, y)) for d, m, y in lines)]
        kept = [x for k, x in enumerate((t or "").split("\n")) if k not in gone]
        out[i] = (gone, "\n".join(kept))
    return out


def corpus():
    rng = random.Random(7)
    base = [prose(rng, rng.randrange(3, 12), 60) for _ in range(25)] + ["日本語の文章です" * 4, "aaaaaaaaaaaaaaaaaaaaaaaa", "abcdefghi", "abcdefghij"]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 8)):
            x = rng.choice(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(x))
                x = rng.choice([x[:k] + x[k + 1:], x[:k] + "Z" + x[k:], x[:k] + "Q" + x[k + 1:]])
            lines.append(rng.choice(["", " ", "\t"]) + x + rng.choice(["", " \r"]))
            if rng.random() < 0.2:
                lines.append(rng.choice(["", "  "]))
        rows.append((i * 2 - 11, "\n".join(lines)))
    return rows + [(1000, None), (1001, ""), (1002, "\n\n"), (1003, "x" * 30_000), (1004, "x" * 29_999 + "y")]


@pytest.mark.parametrize("min_chars", [20, 4, 1])
def test_brute_force(spark, min_chars):
    rows = corpus()
    got = {r["doc_id"]: (list(r["removed"]), r["kept_text"]) for r in L.line_dedup(frame(spark, rows), min_chars).collect()}
    assert got == brute(rows, min_chars)
    assert sum(len(g) for g, _ in got.values()) > 50


def test_short_lines_by_brute_force(spark):
    """Lines of 1 to 20 characters over few letters, many of them one edit apart."""
    rng = random.Random(17)
    rows = [(i, "\n".join("".join(rng.choice("abcd") for _ in range(rng.randrange(0, 21))) for _ in range(12))) for i in range(40)]
    for min_chars in (4, 6):
        got = {r["doc_id"]: (list(r["removed"]), r["kept_text"]) for r in L.line_dedup(frame(spark, rows), min_chars).collect()}
        assert got == brute(rows, min_chars)


def test_no_edits(spark):
    rows = corpus()[:20]
    got = {r["doc_id"]: (list(r["removed"]), r["kept_text"]) for r in L.line_dedup(frame(spark, rows), edits=0).collect()}
    assert got == brute(rows, 1 << 40)
    with pytest.raises(ValueError):
        L.line_dedup(frame(spark, rows), edits=2)


def test_variants_are_emitted_in_bounded_portions(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(L, "_KEYS", 1000)
    lines = ["x" * 3500, "ab", "y" * 999, "é" * 700]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4], pa.int64()), pa.array([0] * 4, pa.int32()), pa.array(lines)], names=["doc_id", "line_no", "line"])
    out = list(L._emit([batch]))
    assert max(b.num_rows for b in out) < 2000 and sum(b.num_rows for b in out) == sum(len(x) + 1 for x in lines)


def test_within_one():
    rng = random.Random(19)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 9)))
        b = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 9)))
        assert L.within_one(a, b) == within_one(a, b)


def test_long_lines(spark):
    """Lines of a megabyte: equal ones, one edit apart, and different ones."""
    rng = random.Random(18)
    long = "".join(rng.choice("abcdefgh ") for _ in range(1_000_000)).strip()
    rows = [(1, long), (2, long[:500_000] + "Q" + long[500_001:]), (3, "z" + long), (4, long[::-1]), (5, f"other\n{long}")]
    got = {r["doc_id"]: r["n_removed"] for r in L.line_dedup(frame(spark, rows)).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0, 5: 1}


def test_nulls_repeats_and_extra_columns(spark):
    schema = "doc_id bigint, text string, line string, first int, near string, removed int"
    line = "one line that is long enough"
    rows = [(None, line, "l", 1, "n", 0), (1, line, "l", 1, "n", 0), (1, line, "l", 1, "n", 0), (2, line + "!", "l", 1, "n", 0)]
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in L.line_dedup(spark.createDataFrame(rows, schema)).collect())
    assert got == [("1", 0), ("1", 0), ("2", 1), ("None", 0)]
    assert L.line_dedup(spark.createDataFrame([], schema)).count() == 0


def test_variants_agree_exactly_within_one_edit():
    p = L.Powers()
    p.reach(2)
    h, pos = L.variants("abcd", p)
    g, at = L.variants("abXd", p)
    assert set(zip(h.tolist(), pos.tolist())) & set(zip(g.tolist(), at.tolist())) == {(h[3], 2)}
    assert L.variants("abd", p)[0][0] == h[3]
