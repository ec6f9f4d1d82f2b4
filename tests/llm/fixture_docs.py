import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

DOCS = "doc_id long, text string, fp string, digest string, row_no string, spans string, kept string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names operators use inside."""

    def of(pairs):
        return spark.createDataFrame([(i, t, "x", None, "y", None, "z") for i, t in pairs], DOCS)

    return of
