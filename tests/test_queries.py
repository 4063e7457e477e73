"""Every registered query against its DuckDB SQL on the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import rows
from holdfast.plans import catalog

ROWS_ONLY = {
    "fit_holdout": 4,
    "fit_documents_holdout": 4,
    "score_holdout": 300,
    "score_accounts": 1500,
    "score_accounts_parity": 1500,
    "score_requests": 1500,
    "score_requests_parity": 1500,
    "score_stream": 1500,
    "predict_stream": None,
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql_or_is_listed():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == set(ROWS_ONLY)
    assert set(catalog.ORACLES) <= set(catalog.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows(spark, sf_dir, duck, name):
    got = contract.queries()[name](spark, sf_dir).toPandas()
    expected = duck.sql(contract.oracle_sql()[name]).df()
    assert len(got) > 0
    assert sorted(got.columns) == sorted(expected.columns)
    assert got.dtypes.sort_index().to_dict() == expected.dtypes.sort_index().to_dict()
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_row_count(spark, sf_dir, name):
    n = contract.queries()[name](spark, sf_dir).count()
    assert n == ROWS_ONLY[name] if ROWS_ONLY[name] else n > 1500


def test_entry(spark):
    first = contract.entry(spark)
    assert first.columns == [
        "customerID", "prediction", "probability", "churn_pct", "retention_pct", "tier", "bars", "verdict",
    ]
    assert first.count() == 150
