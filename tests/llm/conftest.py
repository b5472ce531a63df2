import pytest

from polyspark.session import tune


@pytest.fixture(autouse=True)
def tuned(spark):
    tune(spark)
