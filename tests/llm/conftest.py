"""Small tables with every odd case, for all operators."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest_rows import DOCUMENT, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame([(*r, "s", "h", "c", "d", "x") for r in odd_rows()], DOCUMENT).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENT)
