import pytest

from bronzeway.llm.common import ready


@pytest.fixture(autouse=True)
def importable(spark):
    """Workers of the tests' session find the package."""
    ready(spark)
