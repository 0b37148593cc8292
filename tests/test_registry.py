import duckdb
import pytest

import __spark_entry__ as entry
from millrace.plans.oracle import all_oracles
from millrace.plans.registry import all_queries
from tools.check import TABLES, table_of

QUERIES, ORACLES = all_queries(), all_oracles()

#: 1,000 lines in an hour never make the hundred lines that a window needs for a ratio.
NONE_IN_SMALL_LOG = {"alarm_log", "alarms_issued", "stream_alarm_log"}


@pytest.fixture(scope="module")
def con(data):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, data, name):
    df = QUERIES[name](spark, data)
    answer = con.execute(ORACLES[name])
    wanted = table_of([d[0] for d in answer.description], answer.fetchall())
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    assert len(got[1]) > 0 or name in NONE_IN_SMALL_LOG
    assert got == wanted
    # native expressions only, and joins on keys only
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert node not in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0
