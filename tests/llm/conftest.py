import pytest

# Names that the operators use for columns of their own or of their results.
CLASHES = ["_id", "_tk", "_text", "_row", "_key", "_salt", "size", "target", "taken", "kept", "keep_id", "group_size", "score", "predicted",
           "spans", "n_lines", "n_dropped", "kept_text", "start", "end", "item_id", "epoch", "copies", "c", "h", "n", "label", "links", "block"]


def table(spark, rows, schema="doc_id long, text string, source string"):
    return spark.createDataFrame(rows, schema)


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES if c not in df.columns])


@pytest.fixture(scope="session")
def messy(spark):
    """Null ids, texts and sources, empty and very long texts, repeated rows, and an
    id with two texts."""
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, "one two three four five six", "a"), (2, "one  two three\tfour five six", "b"), (2, "one  two three\tfour five six", "b"),
            (3, None, "a"), (4, "", None), (None, "one two three four five six", "a"), (None, None, None), (5, long_text, "b"),
            (5, "another text altogether of seven words", "c"), (6, long_text + " end", "a"), (7, " \n\t ", "a")]
    return with_clashes(table(spark, rows))


@pytest.fixture(scope="session")
def nothing(spark):
    return with_clashes(table(spark, []))


def dicts(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


