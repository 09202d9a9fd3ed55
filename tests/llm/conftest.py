import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, repeats, and clashing extra columns."""
    long_text = "one two three four five six seven eight nine ten " * 4000
    text = "the quick brown fox jumps over the lazy dog and then it sleeps again for a while " * 4
    rows = [
        (1, text, "en", "a", 5),
        (2, text, "en", "a", 5),
        (2, text, "en", "a", 5),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (None, text, "en", None, 1),
        (5, long_text, "en", "b", 9),
        (6, " \t\n ", None, "b", 3),
        (7, "ein Wort", "de", "c", 8),
        (8, "!!! ### 123", "fr", "c", 3),
        (9, text + " last", "en", "a", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = "id rep key digest guess rating measures piece tokens total part order severity length Score a.b".split()
    for name in clashing:
        docs = docs.withColumn(name, docs["n_chars"])
    return docs


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 1, 0), (2, 0, None), (2, 1, 0), (None, 1, 1), (4, None, 1), (9, 1, 1), (99, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
