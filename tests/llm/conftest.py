import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents of ``(doc_id, text)`` or ``(doc_id, text, source)`` rows, on three partitions."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture
def awkward(documents):
    """Nulls, empty and long texts, ties, repeated rows; columns that clash with inner names."""
    from pyspark.sql import functions as F

    long_text = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, long_text), (6, long_text),
        (7, "A b c d e f g h i j k l m n o p"), (8, "A b c d e f g h i j k l m n o p"),
        (None, "A b c d e f g h i j k l m n o p"), (None, None), (9, "漢字 🙂 ünï"), (9, "other text"),
        (10, "x" * 50_000), (11, "tail"), (11, "tail"), (12, "t", None), (13, "\x00 \x1f a b"),
    ]
    names = ("size", "bits", "words", "fp", "key", "part", "grp", "d", "score", "ids", "sha", "s", "n")
    return documents(rows).select("*", *[F.lit(1).alias(n) for n in names])

