import pytest

from turnstile.llm.common import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SMALL, "documents")


@pytest.fixture(scope="module")
def texts(documents):
    """(doc_id, text) of all documents of the smallest set."""
    return [tuple(r) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def frame(spark):
    """Rows to a DataFrame with the columns of documents and one more whose
    name clashes with a name used inside the operators."""
    schema = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "part int, h bigint, component string")

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t), 7, 8, "x") for i, t, s in rows], schema)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    return [(1, "", "a"), (2, None, "a"), (None, "null id text " * 30, None), (None, None, None),
            (3, " \t\n ", "a"), (4, long_text, "b"), (5, "same row " * 40, "b"), (5, "same row " * 40, "b"),
            (6, "one", None), (5, "same id, other text", "c")]
