import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def one(spark):
    """Evaluate Columns over a single row."""

    def run(*columns, **row):
        if row:
            schema = ", ".join(f"{name} {kind}" for name, (kind, _) in row.items())
            df = spark.createDataFrame([tuple(v for _, v in row.values())], schema)
        else:
            df = spark.range(1)
        got = tuple(df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())
        return got[0] if len(got) == 1 else got

    return run
