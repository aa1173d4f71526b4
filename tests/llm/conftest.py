import pytest
from pyspark.sql import Row

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, spans int"


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts (ids 0, 1, ... unless given), with extra columns whose names clash with inner ones."""
    def make(texts, ids=None, source="s"):
        ids = range(len(texts)) if ids is None else ids
        rows = [Row(doc_id=i, text=t, lang="en", source=source, n_chars=None if t is None else len(t), node="x", spans=1)
                for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, SCHEMA)
    return make


#: Nulls, empty and blank texts, a very long one, ties and odd characters.
ODD = [None, "", " \t\n", "word", "a b c d", "x" * 30_000, "the cat sat on the mat " * 3_000, "é ß 日本 😀", "same text here",
       "same text here", "line\nline\nline", "    spaces \u0085"]
