import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mentionlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a schema string to a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def values(spark):
    """Evaluate a function of a Column over a list of texts."""

    def run(function, texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
        return [r[0] for r in df.orderBy("i").select(function(F.col("x"))).collect()]

    return run
