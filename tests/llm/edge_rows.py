import pytest

#: Rows with nulls, ties, repeats, a column of a clashing name, no words, and one long text.
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, _text string, score int"


def words(n, seed=0):
    return " ".join(f"w{(seed * 7919 + i * i + 3 * i) % 9973}" for i in range(n))


ROWS = [
    (1, words(60, 1), "en", "a", 5, "x", "y", 1),
    (2, words(60, 1), "en", "a", 5, "x", "y", 1),
    (2, words(60, 1), "en", "a", 5, "x", "y", 1),
    (3, words(60, 1) + " tail", None, None, None, None, None, None),
    (4, None, "en", "b", 5, "x", "y", 1),
    (5, "", "fr", "b", 5, "x", "y", 1),
    (6, " \t\n ", "fr", "b", 5, "x", "y", 1),
    (7, "?! 123 ...", "fr", "b", 5, "x", "y", 1),
    (None, words(40, 2), "fr", "", 5, "x", "y", 1),
    (None, None, None, None, None, None, None, None),
    (8, words(40, 3), "fr", "", 5, "x", "y", 1),
    (8, words(30, 4), "fr", "c", 5, "x", "y", 1),
    (9, words(200_000, 5), "en", "c", 5, "x", "y", 1),
    (10, "One.\nOne.\n\nTwo two two two two two", "en", "c", 5, "x", "y", 1),
    (11, "Été À L’ÎLE ß 中文 😀", "fr", "c", 5, "x", "y", 1),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)
