from __future__ import annotations

import pytest

from fraudlens.llm.storage import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)
