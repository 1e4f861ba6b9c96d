import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from trialfold.llm import queries  # noqa: E402


@pytest.fixture(autouse=True)
def prepared(spark):
    queries.prepare(spark)
