import pytest

#: Null, empty, very long, tied, repeated and odd rows (doc_id, text, lang).
LONG = " ".join(f"word{i % 977}" for i in range(60_000)) + "."
ROWS = [
    (1, None, "en"),
    (2, "", None),
    (None, "A text without an id. It has two sentences.", "en"),
    (3, "   \n\t ", "en"),
    (4, "The same text twice over, with some more words to fill the line.\nAnd a second line of it, long enough.", "en"),
    (4, "The same text twice over, with some more words to fill the line.\nAnd a second line of it, long enough.", "en"),
    (5, "The same text twice over, with some more words to fill the line.\nAnd a second line of it, long enough.", "en"),
    (6, LONG, "en"),
    (7, "Ünïcödé 東京 \U0001F600 ñandú — “quoted” ▁ mark  two  spaces", None),
    (8, "x", "fr"),
    (9, "12345 67890", "de"),
    (10, "a\x00b\x1fc\x85d", "es"),
    (None, None, None),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with clashing extra columns."""
    rows = [(*r, "src", len(r[1] or ""), "x", 1, 2, 3, 4.0) for r in ROWS]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "__k string, gone int, node int, h int, score double").cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
