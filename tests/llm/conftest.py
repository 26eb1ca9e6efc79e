import pytest

LONG = " ".join(f"w{k * k % 997}" for k in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, ties, a repeated row, extra columns with clashing names."""
    rows = [
        (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen", "en"),
        (2, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen", "en"),
        (3, " one two three four five six seven eight nine ten eleven twelve thirteen fourteen  fifteen", None),
        (4, None, "en"),
        (5, "", "de"),
        (6, " \n\t", None),
        (7, LONG, "en"),
        (8, LONG + " more", "en"),
        (9, "a\x85b\xa0c\x1cd 中文 ́x 😀\n\n'tis we're I'll it's", "fr"),
        (9, "a\x85b\xa0c\x1cd 中文 ́x 😀\n\n'tis we're I'll it's", "fr"),
        (None, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen", "en"),
        (None, None, None),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return frame.selectExpr("doc_id", "text", "lang", "'x' AS uid", "1 AS size", "2 AS score", "'z' AS kept", "3 AS sha")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
