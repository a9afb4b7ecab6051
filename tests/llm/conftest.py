import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketstream.llm.common import ready  # noqa: E402
from conftest_data import documents  # noqa: E402


@pytest.fixture(scope="session")
def text_spark(spark):
    return ready(spark)


@pytest.fixture(scope="session")
def odd(text_spark):
    return documents(text_spark).repartition(3).persist()


@pytest.fixture(scope="session")
def nothing(text_spark):
    return documents(text_spark, [])
