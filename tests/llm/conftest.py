import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def rows():
    from common_docs import corpus

    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from common_docs import frame

    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def none(spark):
    from common_docs import frame

    return frame(spark, [])
