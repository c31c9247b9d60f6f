import pytest

EDGE_TEXTS = [
    (0, "en", "a", None),
    (1, "en", "a", ""),
    (2, None, None, " \t\n\x0b\x0c\r "),
    (3, "en", "a", "one"),
    (4, "en", "a", "one two three four five six seven eight nine ten eleven twelve"),
    (4, "en", "a", "one two three four five six seven eight nine ten eleven twelve"),
    (5, "en", None, "One TWO three four five six seven eight nine ten eleven twelve"),
    (None, "en", "b", "a row without an id has words too and is a row like any other one"),
    (7, "fr", "b", "Été À la plage où  le café est là\n" * 3),
    (9, "de", "b", " ".join(f"wort{i}" for i in range(30000))),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls everywhere, empty and long texts, equal rows, and columns whose
    names the operators use themselves."""
    rows = [(i, lang, s, t, 1, "k", 2, True, 0.5) for i, lang, s, t in EDGE_TEXTS]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, lang string, source string, text string, id int, key_a string, size int, kept boolean, row double",
    )


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
