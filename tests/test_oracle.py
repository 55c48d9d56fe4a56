"""Every registered query with a DuckDB oracle agrees with it (row count,
column names, order-insensitive values) on the smallest data folder."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, digest

from conftest import SF001

OWN = {name for name in E.queries() if not re.match(r"op\d+_|pipeline$", name)}
SQL = {name: sql for name, sql in E.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_an_oracle_or_is_ml():
    rows_only = OWN - set(SQL)
    assert rows_only == {"lr_full_metrics", "svm_full_metrics", "lr_reduced_metrics",
                         "svm_reduced_metrics", "model_comparison"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(rel.columns, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "pos", "tf"]
    assert df.count() > 0
