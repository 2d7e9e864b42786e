"""Text search and sinks on texts of our own."""

from tessera.operators import search as S
from tessera.sources import sinks

# kept tokens: 0 a, 1 slow, 2 barge, 3 brings, 4 salt, 5 dry, 6 goods, 7 and, 8 rope, 9 to, 10 the, 11 low, 12 harbor,
# 13 in, 14 where, 15 the, 16 slow, 17 barge, 18 rests, 19 at, 20 night; "1999" and "3rd." begin with no a-z
PARAGRAPH = 'A slow barge brings salt, ("dry goods") and rope to the low-lying harbor; in 1999 where the slow barge rests at night, 3rd.'


def docs(spark, text):
    return spark.createDataFrame([(1, text)], "doc_id bigint, text string")


def test_tokenize_paragraph(spark):
    rows = S.tokenize(docs(spark, PARAGRAPH)).orderBy("pos").collect()
    assert [r["word"] for r in rows] == ("a slow barge brings salt dry goods and rope to the low harbor in where the slow barge rests "
                                         "at night").split()
    assert [r["pos"] for r in rows] == list(range(21))


def test_phrase_search_paragraph(spark):
    toks = S.tokenize(docs(spark, PARAGRAPH))
    wanted = ["dry goods", "the low harbor", "slow barge", "barge rests at", "low barge", "rope night"]
    phrases = spark.createDataFrame([(p,) for p in wanted], "phrase string")
    first = {r["phrase"]: (r["start"], r["end"]) for r in S.phrase_search(toks, phrases).collect()}
    assert first == {"dry goods": (5, 6), "the low harbor": (10, 12), "slow barge": (1, 2), "barge rests at": (17, 19)}
    every = sorted((r["start"], r["end"]) for r in S.phrase_search(toks, phrases, first_only=False).where("phrase = 'slow barge'").collect())
    assert every == [(1, 2), (16, 17)]


def test_phrase_search_retries(spark):
    toks = S.tokenize(docs(spark, "red red fox red fox hen"))
    phrases = spark.createDataFrame([("red fox hen",)], "phrase string")
    assert [(r["start"], r["end"]) for r in S.phrase_search(toks, phrases).collect()] == [(3, 5)]


def test_word_count_jvm_rule(spark):
    lines = spark.createDataFrame([("a b  ",), ("",), (" ",), ("a  b",)], "line string")
    got = {r["word"]: r["count"] for r in S.word_count(lines).collect()}
    assert got == {"a": 2, "b": 2, "": 2}


def test_log_records_keys(spark, tmp_path):
    p = tmp_path / "events.csv"
    p.write_text("header\nfirst\nsecond\n")
    lines = sinks.number_text_lines(spark.read.text(str(p)))
    recs = sinks.to_log_records(lines, "t").orderBy("key").collect()
    assert [(r["key"], r["value"]) for r in recs] == [("2", "first"), ("3", "second")]


def test_global_row_number_matches_sort(spark):
    df = spark.range(1000).selectExpr("id", "(id * 7919) % 1000 AS v")
    got = [r["v"] for r in sinks.global_row_number(df, ["v", "id"], num_partitions=7).orderBy("row_no").collect()]
    assert got == sorted(got) and len(got) == 1000


def test_insert_ignore(spark):
    existing = spark.createDataFrame([("s", 1, 1.0), ("s", 2, 2.0)], "symbol string, t int, c double")
    new = spark.createDataFrame([("s", 2, 9.0, 1), ("s", 3, 3.0, 1), ("s", 3, 4.0, 2)],
                                "symbol string, t int, c double, seq int")
    out = sinks.insert_ignore(existing, new, ["symbol", "t"], ["seq"]).collect()
    assert [(r["t"], r["c"]) for r in out] == [(3, 3.0)]
