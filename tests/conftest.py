import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bronzeway.session import make_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = make_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of a function of one column."""

    def evaluate(function, values, ddl="string"):
        rows = spark.createDataFrame([(v,) for v in values], f"c {ddl}")
        return [r[0] for r in rows.select(function(F.col("c"))).collect()]

    return evaluate
