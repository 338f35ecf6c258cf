import pytest

from tallystar.llm.shipping import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Build a documents table from (doc_id, text) or longer tuples."""
    def make(rows, extra=""):
        full = [tuple(r) + ("en", "s0", len(r[1] or ""))[len(r) - 2:] if len(r) < 5 else tuple(r) for r in rows]
        return spark.createDataFrame(full, DOC + extra)
    return make


@pytest.fixture()
def labels(spark):
    def make(rows):
        return spark.createDataFrame([tuple(r) for r in rows], "doc_id long, quality int, toxic int")
    return make
