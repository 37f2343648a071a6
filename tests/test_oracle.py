"""Every registered query against DuckDB on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "customer orders lineitem part documents pages labels".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        kind = str(frame[name].dtype)
        if kind.startswith("datetime") or name.endswith("_date"):
            frame[name] = pd.to_datetime(frame[name]).astype("datetime64[us]")
        elif kind.startswith(("int", "Int")):
            frame[name] = frame[name].astype("float64")
    return frame.sort_values(list(frame.columns), ignore_index=True)


def test_same_keys():
    """Every query has its SQL, but for those of the corpus operators that SQL cannot express."""
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(contract._star_queries()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_oracle(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR).toPandas()
    expected = duck.execute(contract.oracle_sql()[name]).df()
    assert len(expected) > 0
    # equal in every digit, not just approximately
    pd.testing.assert_frame_equal(
        normalised(result), normalised(expected), check_exact=True, check_dtype=False
    )


def test_entry(spark):
    assert contract.entry(spark).count() == 3
