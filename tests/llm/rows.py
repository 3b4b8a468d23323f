"""Small tables with awkward rows, shared by the tests of this folder."""

from __future__ import annotations

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Lorem ipsum dolor sit amet, consectetur adipiscing elit.\n" * 4000

AWKWARD = [
    (1, "the cat sat on the mat and looked at the dog", "en", "a", 44),
    (2, "the cat sat on the mat and looked at the dog", "en", "b", 44),
    (2, "the cat sat on the mat and looked at the dog", "en", "b", 44),
    (3, None, None, None, None),
    (4, "", "en", None, 0),
    (5, " \t\n ", None, "a", 4),
    (None, "a row without an id", "en", "a", 19),
    (None, None, None, None, None),
    (6, "one", "en", "a", 3),
    (7, "ONE", "de", "a", 3),
    (8, LONG, "la", "b", len(LONG)),
    (9, "日本語 テスト 123 😀 ### <|endoftext|>", "ja", "c", 30),
]


def documents(spark, rows=AWKWARD):
    return spark.createDataFrame(rows, DOCUMENTS)


def clashing(docs):
    """``docs`` with more columns named like those that operators use inside."""
    from pyspark.sql import functions as F

    names = ["fp", "score", "name", "hash", "range", "rank", "row", "block", "_place", "_whole", "_id", "y", "h", "n", "v"]
    return docs.select("*", *[F.lit(7).alias(c) for c in names], F.lit("x").alias("a.b"))
