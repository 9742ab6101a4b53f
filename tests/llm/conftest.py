import pytest
from made_texts import prose

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use inside, as columns nobody asked for.
CLASHING = (
    "words", "host", "path", "version", "_version", "text_hash", "lines", "n", "blob", "size", "key", "kind",
    "features", "label", "chief", "x", "y", "root", "node", "bands", "target", "taken", "score", "place", "_right_doc_id",
)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = prose(1, 30000) + " " + "z" * 100_000
    return [
        (1, prose(2, 60), "en", "a", 1),
        (1, prose(2, 60), "en", "a", 1),
        (2, prose(2, 60), "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, " \n\t ", "en", None, 4),
        (6, "One", "en", "b", 3),
        (None, prose(3, 50), "en", "b", 1),
        (None, None, None, None, None),
        (7, long, "de", "b", 1),
        (8, long + " end", "de", "c", 1),
        (9, "é ü 漢字 😀 naïve", "fr", "c", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(3)
    return df.withColumns({name: F.lit("clash") for name in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
