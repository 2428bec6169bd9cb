import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, found int, n_words int"
LONG = "the quick brown fox " * 60_000


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, an empty, a blank and a very long
    text, repeated rows, one id on two texts, and columns named like results."""
    rows = [
        (1, "Hello world, this is a plain text.\nLine two", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \n\t ", "de", "b"),
        (None, "No id here, but a text with words", "en", None),
        (5, "twice", "en", "a"),
        (5, "twice", "en", "a"),
        (6, "one id", "en", "c"),
        (6, "two texts", "fr", "d"),
        (7, LONG, "en", "a"),
        (8, "Ünïcode – 日本語 🎉 <|endoftext|> token = abcdefgh1234", "fr", "b"),
        (None, None, None, None),
    ]
    return spark.createDataFrame([(*r, None, "x", 1, 2) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
