import pytest

LONG = " ".join(f"w{i % 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and very long texts, repeated rows and ids, clashing extra columns."""
    rows = [
        (1, "a b c d e f g h", "en", "s", 15, 9), (1, "a b c d e f g h", "en", "s", 15, 9),
        (2, None, "en", None, None, None), (3, "", None, "s", 0, 1), (None, "no id here at all", None, None, 3, 2),
        (4, "   ", "de", "s", 3, 3), (5, LONG, "en", "s", len(LONG), 4), (6, "x", "fr", "t", 1, 5),
        (7, "tab\tand\nline  two  spaces \n \nend ", "en", "s", 4, 5),
        (8, "漢字 ▁ <|endoftext|> </turn> \\ 😀 \u0000", "zz", "s", 4, 5), (9, "x", "fr", "t", 1, 5)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n_words long").selectExpr(
        "*", "n_words as score", "n_words as ids", "n_words as grp", "n_words as start", "n_words as id")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def some_docs(spark):
    from tests.conftest import SF
    return spark.read.parquet(f"{SF}/documents.parquet")
