import duckdb
import pytest

from millrace.llm.queries import ORACLES, QUERIES
from tools.check import TABLES, table_of

NAMES = {n.split("_")[0] for n in QUERIES}


def test_one_query_for_each_operator():
    assert NAMES == {f"op{n}" for n in range(1, 14)} and len(QUERIES) == 13


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    answer = con.execute(ORACLES[name])
    wanted = table_of([d[0] for d in answer.description], answer.fetchall())
    df = QUERIES[name](spark, data)
    assert table_of(df.columns, [tuple(r) for r in df.collect()]) == wanted and wanted[1]
