import pytest



@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents from (doc_id, text, source) rows, with extra columns of common names."""

    def make(rows):
        rows = [(i, text, source, None, "w", "x") for i, text, source in rows]
        schema = "doc_id bigint, text string, source string, n bigint, window string, node string"
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def words():
    """Deterministic invented words."""
    import random

    def make(count, seed, letters="abcdefghijklmnop"):
        r = random.Random(seed)
        return ["".join(r.choice(letters) for _ in range(r.randrange(2, 9))) for _ in range(count)]

    return make
