import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with extra columns of clashing names."""

    def make(rows):
        full = [(i, t, "en", "src0", len(t or ""), "own", 0.5) for i, t in rows]
        return spark.createDataFrame(full, f"{DOCS}, component_id string, score double")

    return make


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOCS))
