import pytest

SF = "/root/testdata/sf0.001"
#: Names that the operators use themselves.
CLASHING = ("score", "predicted", "held_out", "kept", "node", "value", "shard", "leaf", "taken", "target", "quality", "spans", "m_row", "m_text", "size", "block")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4),
        (4, "one two three", "en", "b", 13),
        (4, "one two three", "en", "b", 13),
        (4, "another text of the same number", "en", "b", 30),
        (5, "One TWO three", "fr", None, 13),
        (None, "one two three", "fr", "c", 13),
        (None, None, None, None, None),
        (7, "word " * 30_000, "en", "a", 150_000),
        (8, "x" * 200_000, "en", "a", 200_000),
        (9, "naïve 漢字 🎉 \x00 <|endoftext|> write to a.b@c.org or +1 (555) 555-0100", "en", "d", 60),
        (10, "line\n" * 3_000, "en", "d", 15_000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("mine").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="session")
def texts(table):
    return {r.doc_id: r.text for r in table("documents").select("doc_id", "text").collect()}
