import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows of a documents table from (doc_id, text) or longer tuples."""

    def make(rows, schema=DOC_SCHEMA):
        width = len(schema.split(","))
        full = [tuple(r) + (None,) * (width - len(r)) for r in rows]
        return spark.createDataFrame(full, schema)

    return make
