"""Queries against the same question asked in SQL of another engine."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import DATA
from fraudlens.llm.oracles import ORACLES
from fraudlens.llm.queries import QUERIES


def test_registered_queries():
    assert set(QUERIES) <= set(contract.queries()) and "pipeline" in contract.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    result = connection.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r) for r in df.select(*names).collect()) == sorted(result.fetchall())
