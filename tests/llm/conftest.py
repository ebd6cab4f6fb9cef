import pytest
from cases import CLASHES, awkward_rows, documents


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward rows, with columns whose names clash with those of operators."""
    from pyspark.sql import functions as F

    docs = documents(spark, awkward_rows())
    return docs.select("*", *[F.lit("clash").alias(c) for c in CLASHES]).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])
