import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from colloquy.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def apply(spark):
    """Evaluate a Column function on a list of values of one type."""

    def run(function, values, dtype="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
        rows = df.select("i", function(F.col("v")).alias("out")).collect()
        return [r["out"] for r in sorted(rows, key=lambda r: r["i"])]

    return run
