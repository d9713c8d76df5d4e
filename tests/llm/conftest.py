import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from rows import ROWS  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def _quiet():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents whose extra columns have names that the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit(1) for c in (
        "kept", "row", "h", "d", "keep_id", "component", "n", "token", "key", "length", "piece",
        "label", "maybe", "_wanted", "_digest_x")})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
