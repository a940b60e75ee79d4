import pytest

from tertulia.llm.registered import vocabulary


@pytest.fixture(scope="session")
def rows(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def bpe():
    return vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty texts, repeated ids and rows, a long word, and columns whose names clash with results."""
    shared = "the same long line of a text that is found in many documents"
    texts = [None, "", " \n\t", "a", shared, shared.upper() + "  \nb", shared, f"{shared}\n{shared}\nc", f"x {shared}", shared + "\n", "w" * 5000, "é😀 " * 200]
    data = [(i, t, None if i % 2 else "en", i, "z") for i, t in enumerate(texts)] + [(None, shared, "en", 1, ""), (4, shared, None, 1, ""), (4, "other", None, 1, "")]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, n_lines int, row string")
