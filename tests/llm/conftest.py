import pytest

# Texts with what operators must bear: null, empty, very long, alike, odd characters.
ROWS = [
    (7, "the cat sat on the mat and the dog sat on the log again and again today", "en", "a"),
    (3, "the cat sat on the mat and the dog sat on the log again and again today", "en", "a"),
    (3, "the cat sat on the mat and the dog sat on the log again and again today", "en", "a"),
    (9, None, "en", "b"),
    (1, "", None, "b"),
    (4, " \t\n ", "fr", None),
    (12, "word " * 30_000, "en", "a"),
    (5, "don't STOP <|endoftext|> écoles é 東京   x🙂 12.5", "fr", "c"),
    (None, "mail joe@example.com or 10.0.0.1 card 4111 1111 1111 1111 +1 (605) 555-9305", "de", "c"),
    (20, "### $$$ |||\nsame line\nsame line\n" + "alpha beta gamma delta " * 20, "es", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    """Rows above, with further columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ROWS, SCHEMA)
    for name in ("hash", "range", "size", "target", "copies", "words", "doc", "fp", "part", "score",
                 "masked", "fence", "base", "length", "id", "k_id"):
        docs = docs.withColumn(name, F.lit(name))
    return docs.repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
