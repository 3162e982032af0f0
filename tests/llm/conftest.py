import pytest

from parley.registry.base import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def docs(spark):
    def make(rows, extra=False):
        """Documents of (doc_id, text) with the other columns, and with columns that operators also use."""
        full = [(i, t, "en", f"src{(i or 0) % 2}", len(t or ""), "x", 7) for i, t in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars int, node string, n int")
        return df if extra else df.drop("node", "n")

    return make
