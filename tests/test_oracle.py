"""Every registered query against its SQL twin on the smallest test data."""

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    return str(value)[:10] if hasattr(value, "year") else float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    ordered = frame[sorted(frame.columns)].astype(object)
    rows = [tuple(plain(v) for v in r) for r in ordered.itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, sf, duck, name):
    got = queries()[name](spark, sf).toPandas()
    expected = duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows_of(got) == rows_of(expected)


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
