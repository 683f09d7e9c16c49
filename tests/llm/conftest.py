import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and blank texts, a very long text, ties, repeated rows and columns with clashing names."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t\n ", "en", "a", 5), (4, long, "en", "b", len(long)), (5, "one two three", None, None, 13),
        (5, "one two three", None, None, 13), (6, "one two three", "en", "a", 13), (None, "one two three", "en", "b", 13), (None, None, None, None, None),
        (7, "é 😀 中文 token='abcdef1234' " * 20, "en", "c", None), (8, "same words again " * 60, "de", "c", 1020),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, rank int, h string, lines int, _id string, _size string, _text int, n_lines string, target string, copies string"
    return spark.createDataFrame([(*r, 0.5, 3, 1, "x", 2, "own", "own", 7, "own", "own", "own") for r in rows], schema)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
