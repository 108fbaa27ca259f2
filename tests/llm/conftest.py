import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    def made(rows):
        return spark.createDataFrame([(i, t, lang, src, None) for i, t, lang, src in rows], DOCS)

    return made


#: Nulls in every column, empty and wordless texts, one very long, ties and repeated rows.
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (2, None, None, None), (3, "", "en", "a"), (4, " \t\n ", "en", None), (None, "no id at all here", None, "b"),
    (5, "word " * 60_000, "en", "a"), (6, "x" * 200_000, "de", "b"), (7, "Ünïcödé \U0001f600 ﬁ ß İ \\ </turn> ### end", "de", "a"),
    (2, "same id another text", "en", "b"), (None, None, None, None), (None, None, None, None),
]


@pytest.fixture(scope="session")
def awkward(documents):
    return documents(AWKWARD)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])
