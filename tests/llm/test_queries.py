"""Every training-data query with SQL agrees with it on the smallest data
folder, and all of them are registered."""
import duckdb
import pytest

import __spark_entry__ as E
from llm_support import SF001
from termflow.llm.queries import ORACLE_SQL, QUERIES
from tools.compare import TABLES, digest


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = QUERIES[name](spark, SF001)
    rows, rel = [tuple(r) for r in df.collect()], con.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns) and rows
    assert digest(df.columns, rows) == digest(rel.columns, rel.fetchall())


def test_all_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())
