from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fraudlens.session import create_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    os.environ["TZ"] = "UTC"
    session = create_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def at(text: str) -> datetime:
    """A time of 2024-01-01 from ``HH:MM:SS[.fff]``."""
    return datetime.fromisoformat(f"2024-01-01 {text}")


def rows(df, *columns: str) -> list[tuple]:
    """The rows as sorted tuples; NULL first."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan(df) -> str:
    """The physical plan as first made, also after the query has run."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
