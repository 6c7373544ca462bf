"""Documents with every awkward case, for all operators."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _raw string, n int, word string, keep string, winner_id long, _gone long, key string, shard int"
LONG = "lorem ipsum dolor sit amet consectetur " * 4000


def documents(spark, texts, first=0):
    """(doc_id, text) rows in a table with columns whose names clash with those the operators use inside."""
    rows = [(t if isinstance(t, tuple) else (first + i, t)) for i, t in enumerate(texts)]
    return spark.createDataFrame([(d, t, "en", None, None, "x", 7, "w", "k", -1, 3, "y", 2) for d, t in rows], SCHEMA)


def awkward(spark):
    return documents(spark, [(1, "the quick brown fox jumps over the lazy dog again and again"), (2, None), (3, ""), (4, "   \n\t "), (None, "a text without an id, the quick brown fox"), (5, LONG), (5, LONG), (6, "the quick brown fox jumps over the lazy dog again and again"), (7, "x" * 3000), (8, "中文 éàü \U0001f600 don't stop"), (9, "1234 5678 #### 0x99ff")])


def empty(spark):
    return documents(spark, [])
