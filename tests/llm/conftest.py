import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash with results."""
    long = " ".join(f"word{i % 977} of{i % 13}" for i in range(30_000))
    rows = [
        (1, "The same line.\nAnd another one.\nA third.", "en", "s", 1),
        (1, "The same line.\nAnd another one.\nA third.", "en", "s", 1),
        (2, None, None, None, None),
        (3, "", "en", "s", 0),
        (None, "a text without an id", "en", None, 3),
        (5, long, "en", "s", 9),
        (6, long + " end", None, "s", 9),
        (7, " \n\t  \r\n ", "fr", "s", 9),
        (8, "12 34 !! ??", "fr", "s", 9),
        (9, "été 日本語 テスト\u3000🙂 it's we'll\n\n\nDON'T", "fr", "s", 9),
        (10, "x" * 70_000, "fr", "s", 9),
        (None, None, None, None, None),
    ]
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    df = spark.createDataFrame(rows, columns)
    for name in ("ids", "n_tokens", "leaves", "score", "n_lines", "key", "node", "bucket", "label", "position", "decoded", "covered"):
        df = df.selectExpr("*", f"'kept' AS {name}")
    return df
