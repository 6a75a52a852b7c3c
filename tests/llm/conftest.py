import pytest

ODD_TEXTS = [None, "", " \n", "one", "two words", "the same text " * 3, "the same text " * 3, "é ünï 中文 😀", "x" * 5000, "w " * 3000]


@pytest.fixture()
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with names the operators use."""
    rows = [(i if i != 3 else None, t, ["a", None, "b"][i % 3], i, "x", i) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], (4, "other text of a repeated id", "a", 1, "y", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, key string, node int")


@pytest.fixture()
def no_documents(odd_documents):
    return odd_documents.where("doc_id = -1")
