import pytest

LONG = " ".join(f"wort{i}" for i in range(30_000))
BASE = " ".join(f"term{i} and then" for i in range(40))


@pytest.fixture
def odd_rows(spark):
    """NULLs, empty and very long texts, ties, repeated rows, and columns whose names clash with an operator's own."""
    rows = [
        (1, "One two three four five six seven eight.", "en"), (2, None, "en"), (3, "", None), (4, " \n ", "de"),
        (5, LONG, "en"), (6, BASE, "en"), (7, BASE, "fr"), (7, BASE, "fr"), (None, BASE + " more", "en"),
        (None, None, None), (8, "!!! ??? 123", "en"), (9, "eins", "de"), (10, BASE.replace("term20", "changed"), "en"),
    ]
    rows = [(a, b, c, 1, "x", 2.5, "y", 3) for a, b, c in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, shard int, t string, score double, `a.b` string, band int")


@pytest.fixture
def no_rows(odd_rows):
    return odd_rows.limit(0)


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
