import pytest

from larderlake.llm.tables import ship

#: Names that the operators use themselves; a table may have them too.
CLASHING = "id string, key long, size long, base string, n long, component string, number int, tree int, words string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns."""
    text = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    rows = [
        (1, text, "en", "a", 1),
        (1, text, "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (None, text, "en", None, 1),
        (None, None, None, None, None),
        (None, None, None, None, None),
        (4, "word " * 60_000, "fr", "b", 1),
        (5, "x" * 200_000, "fr", "b", 1),
        (6, " \t\n\u00a0!?", None, "b", 1),
        (7, text + " é \U0001f600", "en", "", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.selectExpr("*", *(f"cast(7 as {kind}) as {name}" for name, kind in (c.split() for c in CLASHING.split(", "))))


@pytest.fixture(scope="session")
def nothing(spark, awkward):
    return spark.createDataFrame([], awkward.schema)
