import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "para " + "x" * 70_000 + " fin " + "word " * 9_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and
    extra columns whose names the operators use themselves."""
    rows = [
        (0, "the cat sat on the mat and the dog ran away from it", "en", "a"),
        (1, "the cat sat on the mat and the dog ran away from it", "en", "a"),
        (1, "the cat sat on the mat and the dog ran away from it", "en", "a"),
        (2, None, "en", "a"),
        (3, "", "fr", None),
        (4, " \t\n ", None, "b"),
        (5, "12345 !!! ***", "fr", "b"),
        (6, LONG, "fr", "b"),
        (None, "le chat est sur le tapis et le chien est parti", "fr", "a"),
        (None, None, None, None),
        (7, "le chat est sur le tapis et le chien est parti \U0001F600 é ſecret=abcdefghijklmnop", None, None),
        (8, "password = 'hunter2hunter2hunter2'\nGNU General Public License\n\nCC-BY cc by", "en", "a"),
    ]
    schema = T._parse_datatype_string(
        DOCUMENTS + ", id string, chunk string, node string, word string, block int, label string, size double")
    full = [(i, t, lang, s, None if t is None else len(t), "x", None, "n", "w", 3, "l", 1.5) for i, t, lang, s in rows]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}
