import pytest
from helpers import CLASHING, edge_documents, frame


@pytest.fixture(scope="session")
def edge(spark):
    """The edge documents with clashing columns."""
    return frame(spark, edge_documents(), extra=CLASHING).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [], extra=CLASHING)
