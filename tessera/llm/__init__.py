"""Operators of a training-data pipeline.

lm_score         1   stupid-backoff n-gram scores
secrets          2   entropy scan for secrets
embedding_dedup  3   exact metric range join over embeddings
pieces           4   SentencePiece encoding and decoding
line_dedup       5   near-duplicate lines
exact_dedup      6   exact copies
simhash          7   near copies by SimHash
quality          8   quality classifier
substring_dedup  9   repeated word windows
mixing           10  source mixing
periodic         11  periodic runs of words
prefix_trie      12  trie of conversations by their first turns
rans             13  token ids as entropy-coded files
queries          the registered queries over the driver's tables

Every operator takes a DataFrame, reads only the columns that it names (other
columns, whatever they are called, are ignored) and returns columns of its
own, keyed by the document id.
"""
