import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table (with a clashing extra column) from (id, text) rows."""

    def make(rows, schema="doc_id long, text string, n_tokens int, start string"):
        return spark.createDataFrame([(i, t, 7, "x") for i, t in rows], schema)

    return make


ODD = [(3, "It's  A Ünïcode TEST\tx\r\ny ΣΑΣ ́a"), (1, None), (2, ""), (2, "again"), (2, "again"), (None, "no id"),
       (9, "word " * 5000), (10, "x" * 30000), (11, "a<|endoftext|>b"), (12, "password=abcdef0123456789abcdef")]
