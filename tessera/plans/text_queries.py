"""Text queries over whole ``documents`` texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import index as I
from ..operators import search as S
from ..session import cut_lineage
from ..sources.tables import Tables
from .common import register, scratch

N_BIGRAMS = 5
N_TRIGRAMS = 3

# The token rule in words, independent of the code: cut the lower-cased text at
# white space; of each piece, skip the leading characters that are neither letter,
# digit nor underscore, and take the a-z that follow, if any.
_TOKENS_SQL = """
toks AS MATERIALIZED (
  SELECT doc_id, list_filter(list_transform(string_split_regex(lower(text), '[\\s\\x0b\\x1c-\\x1f\\x{85}\\pZ]+'),
                                            lambda x: regexp_extract(ltrim(x, regexp_replace(x, '[\\pL\\pN_]', '', 'g')), '^[a-z]+')),
                             lambda x: x <> '') AS t
  FROM documents),
tokens AS MATERIALIZED (SELECT doc_id, CAST(unnest(range(len(t))) AS INTEGER) AS pos, unnest(t) AS word FROM toks)"""


@register("word_count", """
WITH l AS (SELECT unnest(regexp_split_to_array(regexp_replace(text, '(?:\\r\\n|\\r|\\n)\\z', ''), '\\r\\n|\\r|\\n')) AS line
           FROM documents),
w AS (SELECT unnest(CASE WHEN line = '' THEN ['']
                         WHEN regexp_replace(line, '(?: )+\\z', '') = '' THEN []::VARCHAR[]
                         ELSE string_split(regexp_replace(line, '(?: )+\\z', ''), ' ') END) AS word FROM l)
SELECT word, count(*) AS count FROM w GROUP BY word
""")
def word_count(t: Tables) -> DataFrame:
    """AGG-13: word count of all document lines, single-space JVM split."""
    return S.word_count(S.text_lines(t.documents, "text"), "line", " ")


@register("inverted_index", f"""
WITH {_TOKENS_SQL}
SELECT word, doc_id, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM tokens GROUP BY word, doc_id
""")
def inverted_index(t: Tables) -> DataFrame:
    """TXT-01/02: positional postings per (word, document)."""
    idx = S.build_index(S.tokenize(t.documents))
    return idx.select("word", "doc_id", F.array_join(F.transform("positions", lambda p: p.cast("string")), ",")
                      .alias("positions"))


def _ngram_sql(n: int, k: int) -> str:
    joins = " ".join(f"JOIN tokens t{i} ON t{i}.doc_id = t0.doc_id AND t{i}.pos = t0.pos + {i}" for i in range(1, n))
    text = " || ' ' || ".join(f"t{i}.word" for i in range(n))
    return (f"(SELECT {text} AS phrase, count(*) AS freq FROM tokens t0 {joins} "
            f"GROUP BY 1 ORDER BY freq DESC, phrase LIMIT {k})")


@register("phrase_search", f"""
WITH {_TOKENS_SQL},
ph AS (SELECT phrase FROM {_ngram_sql(2, N_BIGRAMS)} UNION ALL SELECT phrase FROM {_ngram_sql(3, N_TRIGRAMS)}),
pt AS (SELECT phrase, len(string_split(phrase, ' ')) AS n,
              unnest(range(len(string_split(phrase, ' ')))) AS off, unnest(string_split(phrase, ' ')) AS word FROM ph),
hits AS (SELECT pt.phrase, pt.n, t.doc_id, t.pos - pt.off AS start, pt.off FROM tokens t JOIN pt ON t.word = pt.word),
fullm AS (SELECT phrase, doc_id, start, n FROM hits GROUP BY phrase, doc_id, start, n HAVING count(DISTINCT off) = n)
SELECT phrase, doc_id, CAST(min(start) AS BIGINT) AS start, CAST(min(start) + n - 1 AS BIGINT) AS "end"
FROM fullm GROUP BY phrase, doc_id, n
""")
def phrase_search(t: Tables) -> DataFrame:
    """TXT-03: first occurrence per document of the 5 most frequent bigrams
    and the 3 most frequent trigrams of the corpus, found in a stored index."""
    numbered = I.number_docs(S.doc_tokens(t.documents))  # tokenised once, read twice
    phrases = S.top_ngrams_multi(numbered, {2: N_BIGRAMS, 3: N_TRIGRAMS}).select("phrase")
    with scratch(t.spark) as path:
        I.write_index(numbered, path)
        r = I.search_index(t.spark, path, phrases)
        return cut_lineage(r.select("phrase", "doc_id", F.col("start").cast("bigint").alias("start"),
                                    F.col("end").cast("bigint").alias("end")))


@register("stored_index", f"""
WITH {_TOKENS_SQL},
top AS (SELECT word FROM tokens GROUP BY word ORDER BY count(*) DESC, word LIMIT 20)
SELECT word, doc_id, count(*) AS n, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM tokens WHERE word IN (SELECT word FROM top) GROUP BY word, doc_id
""")
def stored_index(t: Tables) -> DataFrame:
    """TXT-02: the index of all words stored, and the postings with positions of
    the 20 most frequent words read from it (the limit is the report's)."""
    with scratch(t.spark) as path:
        I.write_index(I.number_docs(S.doc_tokens(t.documents)), path)
        top = I.directory(t.spark, path).orderBy(F.desc("places"), "word").limit(20)
        rows = I.read_index(t.spark, path, top)
        return cut_lineage(rows.select("word", "doc_id", F.size("positions").cast("bigint").alias("n"),
                                       F.array_join(F.transform("positions", lambda p: p.cast("string")), ",").alias("positions")))


@register("top_bigrams", f"""
WITH {_TOKENS_SQL}
SELECT phrase, freq FROM {_ngram_sql(2, 20)}
""")
def top_bigrams(t: Tables) -> DataFrame:
    """The 20 most frequent bigrams (top-k report feeding phrase search)."""
    return S.top_ngrams(S.doc_tokens(t.documents), 2, 20)
