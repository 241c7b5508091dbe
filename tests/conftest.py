import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from leadloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def one(spark):
    """Evaluate a column over single string values; returns a list."""
    def run(values, expr, schema="v STRING"):
        rows = [v if isinstance(v, tuple) else (v,) for v in values]
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i INT, {schema}")
        return [r["out"] for r in df.select("i", expr.alias("out")).orderBy("i").collect()]

    return run
