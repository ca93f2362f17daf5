import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rankspan.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[8]", app="rankspan-tests", shuffle_partitions=8,
                  extra={"spark.driver.memory": "8g"})
    yield s


@pytest.fixture(scope="session")
def fx(spark):
    from rankspan.sources.fixture import fixture_corpus, fixture_qrels, fixture_queries
    return fixture_corpus(spark), fixture_queries(spark), fixture_qrels(spark)
