"""Comparison of a query with its SQL twin."""

import os

import duckdb

from tests.test_oracle import TABLES, rows_of
from valuekit.llm import registry


def same_as_twin(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    got = registry.QUERIES[name](spark, sf).toPandas()
    expected = con.execute(registry.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows_of(got) == rows_of(expected)
