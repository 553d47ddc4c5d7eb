import pytest
from text_cases import ODD, frame


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with extra columns whose names clash with those the operators use."""
    return frame(spark, ODD, clashes=True)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [], clashes=True)


@pytest.fixture(scope="session")
def sample(spark):
    """Two hundred documents of the smallest table, as a frame and as rows."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, sorted(docs.collect(), key=lambda r: r.doc_id)
