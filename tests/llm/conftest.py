import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallycube.llm.common import tune  # noqa: E402


@pytest.fixture(scope="session")
def llm(spark):
    """The session with the batch limits of the text operators."""
    return tune(spark)


@pytest.fixture
def table(llm):
    def make(rows, schema="doc_id long, text string"):
        return llm.createDataFrame(rows, schema)

    return make
