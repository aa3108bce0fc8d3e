import pytest
from hypothesis import settings

from tidemark.llm.queries import importable

settings.register_profile("unhurried", deadline=None)
settings.load_profile("unhurried")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, _text string, size long"


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    importable(spark)
    prose = " ".join(f"word{n % 97} of the item{n % 31}" for n in range(400))
    long = " ".join(f"very{n} long" for n in range(60_000))
    rows = [
        (1, prose, "en", "a"),
        (2, prose, "en", None),
        (3, None, "en", "a"),
        (4, "", None, "b"),
        (5, " \t\n ", "de", "b"),
        (6, long, "en", "c"),
        (7, long + " and an end", "en", "c"),
        (None, "a row without an id but with a few words", "en", None),
        (8, "one", "en", "d"),
        (9, "???", "en", "d"),
        (10, prose, "en", "a"),
        (10, prose, "en", "a"),
        (11, "the same id and another text", "de", "a"),
        (11, "another text with the same id", "de", "a"),
        (12, "Ünïcode wörds ﬁ 漢字   x y 😀 end", "de", "e"),
    ]
    return spark.createDataFrame([(*row, None, False, "mine", -1) for row in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {row.doc_id: row.text for row in docs.collect()}
