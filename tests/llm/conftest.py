import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

LONG = "the quick brown fox jumps over the lazy dog and runs on " * 1500
#: Nulls, empty and blank texts, a very long one, repeated rows, odd characters, special tokens.
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, LONG), (5, "hi"), (5, "hi"), (None, "no id here at all"),
       (None, None), (6, "x" * 9000), (7, "日本語 é̃ \x1c🙂 a\u0085b"), (8, "<|endoftext|> and <|startoftext|>!"),
       (9, "The same five words here again and again."), (10, "the same FIVE words here again and again."),
       (11, "mail me at a.b@c.de or +1 (555) 010-9999, 4111 1111 1111 1111 and 10.0.0.255 ok"),
       (12, "one two three"), (13, "one two three")]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd rows, with columns whose names the operators use inside."""
    schema = T.StructType([*DOCS.fields, *[T.StructField(n, T.StringType()) for n in (
        "words", "row", "cid", "spans", "part", "kept", "doc", "k1", "n_words")]])
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *["z"] * 9) for i, t in ODD], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    """Sorted rows as tuples; nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, str(type(x)), x) for x in r])
