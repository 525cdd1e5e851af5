import pytest
from hard_rows import EDGE, SCHEMA


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t, lang, None, len(t) if t else None, 1, 2, "d", "k", 3, 4, "t") for i, t, lang in EDGE]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
